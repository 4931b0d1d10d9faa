"""Substring dedup by paragraph MinHash banding.

Units of a text that can repeat elsewhere:

* *paragraphs*, lines of at least MIN_WORDS words: a MinHash signature over their 5-word
  shingles, cut into BANDS bands of ROWS values; recall 1 - (1 - J**ROWS)**BANDS is 0.996 at
  a Jaccard similarity J of 0.75 and above 0.9999 at 0.9;
* *excerpts*, runs of EXCERPT_WORDS words that begin at content-chosen places (the least
  5-word hash of each GAP places): a signature of one value, which finds passages that were
  spliced into other paragraphs.  Any run of MIN_WORDS words that two texts share holds a
  shared excerpt.

Units that collide in a value are first paired with the lowest one (doc_id, then place), so a
passage in n documents costs n pairs.  Where that fails, a second round follows.  Paragraphs of
one value in different components are paired with each other.  Marks, a bitmap of a paragraph's
shingles and their number, bound the similarity of a pair from above: narrow ones travel with
the values, wide ones with the paragraphs left for the second round.  Pairs whose bound is too low
are never fetched.  For an excerpt whose lowest
holder shares too little with another one, all holders give the MIN_WORDS-word windows around
it, and a window's lowest holder keeps it: that is n rows for n holders, too.  Colliding paragraphs are
verified by exact Jaccard similarity and grouped into connected components: the lowest of a
component stays, the others are removals.  Colliding excerpts are verified on the texts and
extended word by word to the whole run both texts share; runs of MIN_WORDS words or more are
removals.  Removals of a document are merged and cut out of its text; shorter repeats stay.

A bounded filter first drops values that occur once, so only shared units are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsmith.llm.common import connected_components, merge_components, small_arrow_batches, stored, text_chars
from logsmith.llm.sketches import holding, may_repeat, repeat_filter
from logsmith.llm.words import mix, shingle_hashes, sliding, word_hashes, words_and_lines
from logsmith.scratch import drop_scratch, scratch_mark

MIN_WORDS = 50
SHINGLE_WORDS = 5
SIMILARITY = 0.75
BANDS, ROWS = 10, 3
EXCERPT_WORDS = 20
#: 64-bit words in the narrow and wide bitmaps of a paragraph's shingles.
NARROW, WIDE = 4, 16
#: Others that a paragraph left may have to meet, on average, in the last round.
LAST_ROUND = 32
GAP = MIN_WORDS - EXCERPT_WORDS - SHINGLE_WORDS + 2  # so that a shared run of MIN_WORDS holds a shared excerpt

#: Words compared in one step of the search for common runs.
RUN_CELLS = 1 << 18

EXCERPT, PARAGRAPH = 0, 1

_rng = np.random.default_rng(75)
_MULTIPLY = _rng.integers(1, 2 ** 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 2 ** 63, BANDS * ROWS, dtype=np.uint64)


def excerpts(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word in the batch, value) of the excerpts of all texts of a batch."""
    if len(words) < EXCERPT_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = shingle_hashes(words, SHINGLE_WORDS)
    if len(grams) >= GAP:
        least = sliding(grams, GAP, np.minimum)
        edge = np.zeros(GAP - 1, dtype=np.uint64)
        anchors = np.flatnonzero(grams == sliding(np.concatenate([edge, least, edge]), GAP, np.maximum))
    else:
        anchors = np.array([int(grams.argmin())])
    # near the ends of short texts the windows reach into neighbours: the first place counts too
    anchors = np.union1d(anchors, offsets[:-1][np.diff(offsets) >= EXCERPT_WORDS])
    owner = np.searchsorted(offsets, anchors, side="right") - 1
    anchors = anchors[anchors + EXCERPT_WORDS <= offsets[owner + 1]]
    return anchors, shingle_hashes(words, EXCERPT_WORDS)[anchors]


def paragraphs(words: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) words of the lines of MIN_WORDS words or more."""
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
    end = np.append(first[1:], len(words))
    long = end - first >= MIN_WORDS
    return first[long], end[long]


def minhash_bands(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Band values (a row per paragraph, BANDS columns)."""
    if not len(first):
        return np.empty((0, BANDS), np.uint64)
    grams = shingle_hashes(words, SHINGLE_WORDS)
    bounds = np.stack([first, end - SHINGLE_WORDS + 1], axis=1).ravel()
    grams = np.append(grams, np.uint64(2 ** 64 - 1))
    out = np.empty((len(first), BANDS), np.uint64)
    for band in range(BANDS):
        value = np.full(len(first), band + 1, np.uint64)
        for row in range(ROWS):
            i = band * ROWS + row
            mixed = grams * _MULTIPLY[i] + _ADD[i]
            value = mix(value * np.uint64(31) + np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), bounds)[::2])
        out[:, band] = value
    return out


def shingle_marks(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, bitmap of WIDE 64-bit words) of each paragraph: a bit for each hashed shingle."""
    sizes, bitmap = np.zeros(len(first), np.int64), np.zeros((len(first), WIDE), np.uint64)
    if len(first):
        places = end - SHINGLE_WORDS + 1 - first
        owner = np.repeat(np.arange(len(first)), places)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(places) - places, places) + first[owner]
        grams = shingle_hashes(words, SHINGLE_WORDS)[at]
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.append(True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))
        sizes = np.bincount(owner[new], minlength=len(first))
        slot = mix(grams[new]) % np.uint64(64 * WIDE)
        np.bitwise_or.at(bitmap, (owner[new], (slot >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (slot & np.uint64(63)))
    return sizes, bitmap


def narrowed(bitmap: np.ndarray) -> np.ndarray:
    """Wide bitmaps folded to narrow ones."""
    return np.bitwise_or.reduce(bitmap.reshape(len(bitmap), WIDE // NARROW, NARROW), axis=1)


def may_be_similar(x: Column, y: Column, width: int) -> Column:
    """False only for marks of paragraphs below SIMILARITY.

    A bit of one bitmap that the other lacks stands for a shingle that the other lacks.
    """
    def common(a: Column, b: Column) -> Column:
        lacking = [F.bit_count(a[f"m{i}"].bitwiseAND(F.bitwise_not(b[f"m{i}"]))) for i in range(width)]
        return a["n"] - sum(lacking[1:], lacking[0])
    least = SIMILARITY * (x["n"] + y["n"])  # with c in common: c >= SIMILARITY * (n + n' - c)
    return ((1 + SIMILARITY) * common(x, y) >= least) & ((1 + SIMILARITY) * common(y, x) >= least)


def _units(texts: list[str | None]):
    """Words, offsets, excerpts and paragraphs with bands of a batch."""
    words, offsets, lines = words_and_lines(texts)
    at, value = excerpts(words, offsets)
    first, end = paragraphs(words, lines)
    return words, offsets, at, value, first, end, minhash_bands(words, first, end)


def _values(batch: pa.RecordBatch) -> np.ndarray:
    *_, value, _first, _end, bands = _units(batch.column("text").to_pylist())
    return np.concatenate([value, bands.ravel()])


def _marks(sizes: np.ndarray, bitmap: np.ndarray, missing: np.ndarray | None = None) -> pa.StructArray:
    columns = {"n": sizes} | {f"m{i}": bitmap[:, i] for i in range(bitmap.shape[1])}
    return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns.values()], names=list(columns),
                                      mask=None if missing is None else pa.array(missing))


def _shared_units(shared):
    """Per document: (value, kind, place, narrow marks) of its units whose value may occur twice, and
    (place, wide marks) of the paragraphs among them."""
    def run(batches):
        bits = shared.value
        for batch in batches:
            all_words, offsets, at, value, first, end, bands = _units(batch.column(1).to_pylist())
            n = len(bands)
            values = np.concatenate([value, bands.ravel()])
            words = np.concatenate([at, np.repeat(first, BANDS)])
            kinds = np.concatenate([np.full(len(at), EXCERPT), np.full(n * BANDS, PARAGRAPH)])
            kept = np.flatnonzero(may_repeat(bits, values)) if len(values) else np.empty(0, np.int64)
            owner = np.searchsorted(offsets, words[kept], side="right") - 1
            order = np.argsort(owner, kind="stable")
            kept, owner = kept[order], owner[order]
            bounds = np.searchsorted(owner, np.arange(len(offsets)))
            which = np.maximum(kept - len(at), 0) // BANDS
            some, which = np.unique(which[kinds[kept] == PARAGRAPH], return_inverse=True)
            sizes, bitmap = shingle_marks(all_words, first[some], end[some])
            row = np.full(len(kept), len(some))
            row[kinds[kept] == PARAGRAPH] = which
            marks = _marks(np.append(sizes, 0)[row], np.append(narrowed(bitmap), np.zeros((1, NARROW), np.uint64), axis=0)[row],
                           kinds[kept] == EXCERPT)
            whose = np.searchsorted(offsets, first[some], side="right") - 1
            wide = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(whose, np.arange(len(offsets))).astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array((first[some] - offsets[whose]).astype(np.int32)), _marks(sizes, bitmap)], names=["place", "marks"]))
            units = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(values[kept].astype(np.int64)), pa.array(kinds[kept].astype(np.int32)),
                 pa.array((words[kept] - offsets[owner]).astype(np.int32)), marks], names=["value", "kind", "place", "marks"]))
            held = pa.array(np.flatnonzero(np.diff(bounds)))
            yield pa.RecordBatch.from_arrays([c.take(held) for c in (batch.column(0), units, wide)], names=["id", "units", "wide"])
    return run


def _marks_type(width: int) -> str:
    return f"struct<n:long,{','.join(f'm{i}:long' for i in range(width))}>"


_SHARED_SCHEMA = ("id struct<doc_id:long,doc_key:long>, "
                  f"units array<struct<value:long,kind:int,place:int,marks:{_marks_type(NARROW)}>>, "
                  f"wide array<struct<place:int,marks:{_marks_type(WIDE)}>>")


def _colliding(shared: DataFrame) -> DataFrame:
    """(value, kind, unit, marks, low, near): the units of values that occur twice, with the lowest of
    each, and whether the marks let the two be similar (true for excerpts).

    The minimum is partial before its shuffle; both sides of the join are stored scans, so a
    value that holds a third of all rows is split by the adaptive skew join.
    """
    units = stored(shared.select("id", F.explode("units").alias("u")).select(
        "u.value", "u.kind", F.struct("id.doc_id", "id.doc_key", "u.place").alias("unit"), "u.marks"), "repeat-units")
    low = stored(units.groupBy("value", "kind").agg(F.min(F.struct("unit", "marks")).alias("least"), F.max("unit").alias("high"))
                 .where("least.unit != high").select("value", "kind", "least"), "repeat-low")
    near = F.coalesce(may_be_similar(F.col("marks"), F.col("least.marks"), NARROW), F.lit(True))
    return units.join(low, ["value", "kind"]).select(
        "value", "kind", "unit", "marks", F.col("least.unit").alias("low"), near.alias("near"))


def _pairs(met: DataFrame) -> DataFrame:
    """(value, kind, unit, low) -> (doc_key, low_key, seeds): for each pair of documents the places
    where units of the first share a value with units of the second."""
    return met.groupBy(F.col("unit.doc_key").alias("doc_key"), F.col("low.doc_key").alias("low_key")).agg(
        F.collect_set(F.struct("kind", F.col("unit.place").alias("place"), F.col("low.place").alias("low"))).alias("seeds"))


def _further_links(colliding: DataFrame, links: DataFrame, docs: DataFrame, wide: DataFrame) -> DataFrame:
    """All links between similar paragraphs that share a value, given those with the lowest of each value.

    Values whose paragraphs are in different components go on in rounds: a few paragraphs of each
    value, four times as many in every round, meet all its paragraphs of other components and then
    leave the value.  Links join components on the way, so near copies of a paragraph come together
    in the first rounds and are not paired with each other.  Once the paragraphs left would meet
    no more than LAST_ROUND others on average, all meet in one last round.  No pair is verified
    twice.  ``wide``: (node, marks) of the paragraphs.
    """
    ends = lambda rows: rows.select(_node("low_key", "low_first").alias("a"), _node("doc_key", "first").alias("b"))
    part = stored(connected_components(ends(links)), "paragraph-star-parts")
    units = (colliding.where((F.col("kind") == PARAGRAPH) & (F.col("unit") != F.col("low")))
             .withColumn("node", _node("unit.doc_key", "unit.place")).join(part, "node", "left")
             .select("value", "unit", "node", F.coalesce("component", "node").alias("part")))
    rows, meetings = _open(units)
    if not meetings:
        return links
    # plain columns, not structs: generated code for the join below stays small enough to be compiled
    fields = ["n", *(f"m{i}" for i in range(WIDE))]
    wide = wide.join(rows.select("node"), "node", "left_semi").dropDuplicates(["node"]).select("node", "marks.*")
    rows = stored(rows.join(wide, "node"), "paragraph-marked")
    own = ["unit", "part", "node", *fields]
    met, width = None, 1
    while meetings:
        last = meetings <= LAST_ROUND * rows.count()
        speakers = rows
        if not last:
            speakers = stored(rows.groupBy("value", F.pmod(F.xxhash64("node"), F.lit(width)).alias("no")).agg(
                F.min(F.struct(*own)).alias("s")).select("value", "s.*"), "paragraph-speakers")
        met_by = speakers.select("value", *(F.col(c).alias(f"s_{c}") for c in own))
        marks = F.struct(*fields), F.struct(*(F.col(f"s_{c}").alias(c) for c in fields))
        pairs = (rows.join(met_by, "value").where(F.col("part") != F.col("s_part"))
                 .where(F.col("node") < F.col("s_node") if last else F.lit(True)).where(may_be_similar(*marks, WIDE))
                 .select(F.greatest("unit", "s_unit").alias("unit"), F.least("unit", "s_unit").alias("low"),
                         F.least("node", "s_node").alias("a"), F.greatest("node", "s_node").alias("b"))
                 .dropDuplicates(["a", "b"]))
        pairs = stored(pairs if met is None else pairs.join(met, ["a", "b"], "left_anti"), "paragraph-met")
        met = pairs.select("a", "b") if met is None else met.union(pairs.select("a", "b"))
        found = _similar_pairs(pairs, docs)
        links = links.unionByName(found)
        if last:
            break
        part, renamed = merge_components(part, ends(found))
        rest = rows.join(speakers.select("value", "node"), ["value", "node"], "left_anti")
        rest = (rest.join(renamed, rest["part"] == renamed["old"], "left")
                .select("value", "unit", "node", F.coalesce("new", "part").alias("part"), *fields))
        rows, meetings = _open(rest)
        width *= 4
    return links


def _open(units: DataFrame) -> tuple[DataFrame, int]:
    """The rows (value, part, ...) of values whose paragraphs are in more than one component, and how
    many pairs of them are in different ones."""
    units = stored(units, "paragraph-units")
    several = stored(units.groupBy("value", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("value").agg(
        ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).cast("long").alias("meetings"))
        .where("meetings > 0"), "paragraph-several")
    rows = stored(units.join(several.select("value"), "value", "left_semi"), "paragraph-open")
    return rows, several.agg(F.sum("meetings")).first()[0] or 0


def _shingle_sets(batches):
    """(doc_key, places, text) -> (doc_key, first, end, grams): the lines at the places, and their shingles."""
    for batch in batches:
        keys, places = (batch.column(i).to_pylist() for i in range(2))
        words, offsets, lines = words_and_lines(batch.column(2).to_pylist())
        out = []
        for i, key in enumerate(keys):
            own = slice(offsets[i], offsets[i + 1])
            for place in places[i]:
                first, end = _lines_at(words[own], lines[own], place)
                out.append((key, first, end, np.unique(shingle_hashes(words[own][first:end], SHINGLE_WORDS)).astype(np.int64)))
        columns = zip(*out) if out else [[]] * 4
        types = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_key", "first", "end", "grams"])


def _similar_pairs(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(unit, low, a, b) -> links of the pairs of paragraphs that are similar."""
    units = pairs.select("unit.doc_key", "unit.place").union(pairs.select("low.doc_key", "low.place"))
    places = stored(units.groupBy("doc_key").agg(F.collect_set("place").alias("places")), "paragraph-places")
    grams = stored(places.join(_texts(docs, places.select(F.col("doc_key").alias("key"))), F.col("doc_key") == F.col("key"))
                   .select("doc_key", "places", "text")
                   .mapInArrow(_shingle_sets, "doc_key long, first int, end int, grams array<long>"), "paragraph-grams")
    own = grams.select(F.col("doc_key").alias("k"), F.col("first").alias("f"), "end", F.col("grams").alias("x"))
    low = grams.select(F.col("doc_key").alias("l"), F.col("first").alias("g"), F.col("end").alias("low_end"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return stored(pairs.join(own, (F.col("unit.doc_key") == F.col("k")) & (F.col("unit.place") == F.col("f")))
                  .join(low, (F.col("low.doc_key") == F.col("l")) & (F.col("low.place") == F.col("g")))
                  .where(both >= SIMILARITY * (F.size("x") + F.size("y") - both))
                  .select(F.lit(PARAGRAPH).alias("kind"), F.col("k").alias("doc_key"), F.col("f").alias("first"), "end",
                          F.col("l").alias("low_key"), F.col("g").alias("low_first"), "low_end"), "paragraph-similar")


def _node(key: str, first: str):
    return F.xxhash64(key, first)


def _windows(batches):
    """(doc_id, doc_key, places, text) -> (window, unit): the MIN_WORDS-word windows around excerpts."""
    for batch in batches:
        ids, keys, places = (batch.column(i).to_pylist() for i in range(3))
        words, offsets, _ = words_and_lines(batch.column(3).to_pylist())
        for i, at in enumerate(places):
            own = words[offsets[i]:offsets[i + 1]]
            if len(own) < MIN_WORDS:
                continue
            firsts = np.unique(np.add.outer(np.array(at), np.arange(EXCERPT_WORDS - MIN_WORDS, 1)))
            firsts = firsts[(firsts >= 0) & (firsts + MIN_WORDS <= len(own))]
            n = len(firsts)
            unit = pa.StructArray.from_arrays([pa.array([ids[i]] * n, pa.int64()), pa.array([keys[i]] * n, pa.int64()),
                                               pa.array(firsts.astype(np.int32))], names=["doc_id", "doc_key", "place"])
            yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(own, MIN_WORDS)[firsts].astype(np.int64)), unit],
                                             names=["window", "unit"])


def _window_removals(colliding: DataFrame, runs: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_key, first, end): repeated windows around the excerpts that some holder does not share
    with the lowest one for MIN_WORDS words.  ``runs`` are the runs that are shared with lowest ones."""
    holders = colliding.where(F.col("kind") == EXCERPT)
    runs = runs.select(F.col("doc_key").alias("of"), "first", "end")
    missed = holders.where("unit != low").join(
        runs, (F.col("unit.doc_key") == F.col("of")) & (F.col("first") <= F.col("unit.place"))
        & (F.col("unit.place") + EXCERPT_WORDS <= F.col("end")), "left_anti")
    missed = stored(missed.select("value").distinct(), "repeat-missed")
    places = stored(holders.join(missed, "value", "left_semi").groupBy("unit.doc_id", "unit.doc_key").agg(
        F.collect_set("unit.place").alias("places")), "repeat-places")
    windows = stored(places.join(_texts(docs, places.select(F.col("doc_key").alias("key")).distinct()), F.col("doc_key") == F.col("key"))
                     .select("doc_id", "doc_key", "places", "text")
                     .mapInArrow(_windows, "window long, unit struct<doc_id:long,doc_key:long,place:int>"), "repeat-windows")
    low = stored(windows.groupBy("window").agg(F.min("unit").alias("low"), F.max("unit").alias("high"))
                 .where("low != high").select("window", "low"), "repeat-window-low")
    return windows.join(low, "window").where("unit != low").select(
        "unit.doc_key", F.col("unit.place").alias("first"), (F.col("unit.place") + MIN_WORDS).alias("end"))


def shared_runs(a: np.ndarray, b: np.ndarray, place: np.ndarray, low: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the different maximal runs of ``a``, of MIN_WORDS words or more, that equal words of
    ``b`` at a seed's offset and hold the seed's excerpt.  Seeds: excerpts at ``place`` in a, ``low`` in b.

    Offsets go together in steps of RUN_CELLS words.
    """
    offset = low - place
    if same:
        place, offset = place[offset < 0], offset[offset < 0]
    offsets, which = np.unique(offset, return_inverse=True)
    seeds = np.sort(which * (len(a) + 1) + place)
    found = [np.empty((0, 2), np.int64)]
    step = max(RUN_CELLS // max(len(a), 1), 1)
    for at in range(0, len(offsets), step):
        other = np.arange(len(a)) + offsets[at:at + step, None]
        equal = np.zeros((len(other), len(a) + 2), np.int8)
        equal[:, 1:-1] = (a == b[np.clip(other, 0, len(b) - 1)]) & (other >= 0) & (other < len(b))
        edge = np.diff(equal, axis=1)
        (row, first), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        long = end - first >= MIN_WORDS
        row, first, end = row[long] + at, first[long], end[long]
        base = row * (len(a) + 1)
        seed = np.append(seeds, np.iinfo(np.int64).max)[np.searchsorted(seeds, base + first)]
        held = seed <= base + end - EXCERPT_WORDS
        found.append(np.stack([first[held], end[held]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[:, 0], runs[:, 1]


def _lines_at(words: np.ndarray, lines: np.ndarray, place: int) -> tuple[int, int]:
    """First and end word of the line that begins at a word."""
    return place, int(np.searchsorted(lines, lines[place], side="right"))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the shingle sets of two word sequences reach SIMILARITY."""
    s, t = (np.unique(shingle_hashes(x, SHINGLE_WORDS)) for x in (a, b))
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both >= SIMILARITY * (len(s) + len(t) - both)


_VERIFIED = {"kind": pa.int32(), "doc_key": pa.int64(), "first": pa.int32(), "end": pa.int32(),
             "low_key": pa.int64(), "low_first": pa.int32(), "low_end": pa.int32()}


def _verify(batches):
    """(doc_key, low_key, seeds, text, low_text) -> runs of excerpts and pairs of similar paragraphs."""
    for batch in batches:
        keys, lows = (batch.column(i).to_numpy() for i in range(2))
        bounds, seeds = batch.column(2).offsets.to_numpy(), batch.column(2).values
        kind, place, low = (seeds.field(c).to_numpy() for c in ("kind", "place", "low"))
        # each text of the batch is hashed once
        _, one, which = np.unique(np.concatenate([keys, lows]), return_index=True, return_inverse=True)
        texts = pa.concat_arrays([batch.column(3), batch.column(4)]).take(pa.array(one)).to_pylist()
        words, offsets, lines = words_and_lines(texts)
        span = lambda j: slice(offsets[which[j]], offsets[which[j] + 1])
        out = [np.empty((0, len(_VERIFIED)), np.int64)]
        for i in range(len(keys)):
            x, y = span(i), span(len(keys) + i)
            a, b = words[x], words[y]
            own = slice(bounds[i], bounds[i + 1])
            excerpt = kind[own] == EXCERPT
            first, end = shared_runs(a, b, place[own][excerpt].astype(np.int64), low[own][excerpt].astype(np.int64), keys[i] == lows[i])
            rows = np.zeros((len(first), len(_VERIFIED)), np.int64)
            rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], rows[:, 4] = EXCERPT, keys[i], first, end, lows[i]
            out.append(rows)
            for p, q in zip(place[own][~excerpt].tolist(), low[own][~excerpt].tolist()):
                (s, e), (t, f) = _lines_at(a, lines[x], p), _lines_at(b, lines[y], q)
                if similar(a[s:e], b[t:f]):
                    out.append(np.array([[PARAGRAPH, keys[i], s, e, lows[i], t, f]], np.int64))
        columns = np.concatenate(out).T
        yield pa.RecordBatch.from_arrays([pa.array(c, t, safe=False) for c, t in zip(columns, _VERIFIED.values())], names=list(_VERIFIED))


def _paragraph_removals(links: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_key, first, end) of the paragraphs that repeat a lower one of their component."""
    ends = links.select("doc_key", "first", "end").union(links.select("low_key", "low_first", "low_end")).distinct()
    ends = ends.withColumn("node", _node("doc_key", "first")).join(ids, "doc_key")
    parts = connected_components(links.select(_node("low_key", "low_first").alias("a"), _node("doc_key", "first").alias("b")))
    parts = stored(ends.join(parts, "node").select(
        F.struct("doc_id", "doc_key", "first").alias("unit"), "end", "component"), "paragraph-parts")
    keepers = stored(parts.groupBy("component").agg(F.min("unit").alias("keeper")), "paragraph-keepers")
    return (parts.join(keepers, "component").where("unit != keeper")
            .select("unit.doc_key", "unit.first", "end"))


def _doc_key():
    return F.xxhash64("doc_id", "text")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of the wanted keys: one row per key, as repeated rows have one text."""
    return holding(docs.select(_doc_key().alias("key"), "text"), "key", stored(wanted, "repeat-wanted")).dropDuplicates(["key"])


def _pair_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, text) of the documents of pairs; both joins of ``_verified`` read one shuffle of it."""
    return _texts(docs, pairs.select(F.col("doc_key").alias("key")).union(pairs.select("low_key")).distinct())


def _verified(pairs: DataFrame, by_key: DataFrame) -> DataFrame:
    """Runs of excerpts and pairs of similar paragraphs, from the texts of the pairs of documents."""
    return stored(pairs.join(by_key.select(F.col("key").alias("doc_key"), "text"), "doc_key")
                  .join(by_key.select(F.col("key").alias("low_key"), F.col("text").alias("low_text")), "low_key")
                  .select("doc_key", "low_key", "seeds", "text", "low_text")
                  .mapInArrow(_verify, "kind int, doc_key long, first int, end int, low_key long, low_first int, "
                                       "low_end int"), "repeat-verified")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_key, spans): word spans [first, end) to cut, for the documents that have any.

    doc_key is xxhash64(doc_id, text).
    """
    spark, mark = docs.sparkSession, scratch_mark()
    small_arrow_batches(spark)
    texts = docs.select("text")
    bits = spark.sparkContext.broadcast(repeat_filter(texts, _values, text_chars(texts) // 40))
    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), _doc_key().alias("doc_key")).alias("id"),
                        "text")
    shared = stored(keyed.mapInArrow(_shared_units(bits), _SHARED_SCHEMA), "repeat-shared")
    colliding = stored(_colliding(shared), "repeat-colliding")
    pairs = stored(_pairs(colliding.where("near and unit != low")), "repeat-pairs")
    verified = _verified(pairs, _pair_texts(pairs, docs))
    links, runs = (verified.where(F.col("kind") == kind) for kind in (PARAGRAPH, EXCERPT))
    wide = shared.select("id.doc_key", F.explode("wide").alias("w")).select(
        _node("doc_key", "w.place").alias("node"), "w.marks")
    links = _further_links(colliding, links, docs, wide)
    ids = shared.select("id.doc_id", "id.doc_key").distinct()
    spans = _paragraph_removals(links, ids).unionByName(runs.select("doc_key", "first", "end")).unionByName(
        _window_removals(colliding, runs, docs))
    spans = stored(spans.groupBy("doc_key").agg(F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans")),
                   "repeat-spans")
    drop_scratch(spark, spans, since=mark)
    return spans


def cut_words(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the words of the spans (sorted), and how many words went.

    The white space after a span goes with it; at the end of a text, that before it.
    """
    data = text.encode("utf-8", "surrogatepass")
    _, _, starts, ends = word_hashes([text], spans=True)
    kept, at, done, gone = [], 0, 0, 0
    for first, end in spans:
        first, end = max(first, done), min(end, len(starts))
        if first >= end:
            continue
        kept.append(data[at:starts[first]])
        at = int(starts[end]) if end < len(starts) else len(data)
        gone += end - first
        done = end
    out = b"".join(kept)
    out = out.rstrip(b" \t\n\r\x0b\x0c") if gone and at == len(data) else out + data[at:]
    return out.decode("utf-8", "surrogatepass"), gone


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, plus ``removed_words`` and ``removed_spans``.

    Every input row gives one row; all columns are kept, but columns named like the two new
    ones are replaced.  The lowest place of a passage (smallest doc_id, null first, then the
    hash of id and text, then the place in the text) keeps it; a text may become empty.  Null,
    empty and short texts come back as they are, with 0 words removed.  Rows that repeat both
    id and text are one document, and are cut alike.  An empty table gives no rows.
    """
    spans = repeated_spans(docs)
    plain = [c for c in docs.columns if c not in ("removed_words", "removed_spans")]
    fields = docs.select(*plain).schema.fields
    at = plain.index("text")

    def cut(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(len(plain)).to_pylist()
            gone = [0] * len(texts)
            for i, s in enumerate(spans):
                if s and texts[i] is not None:
                    texts[i], gone[i] = cut_words(texts[i], [(x["first"], x["end"]) for x in s])
            columns = list(batch.columns[:len(plain)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(gone, pa.int64()), batch.column(len(plain))],
                names=[*plain, "removed_words", "removed_spans"])

    span_type = spans.schema["spans"].dataType
    schema = T.StructType([*fields, T.StructField("removed_words", T.LongType()), T.StructField("removed_spans", span_type)])
    return (docs.select(*plain, _doc_key().alias("__key"))
            .join(spans.select(F.col("doc_key").alias("__key"), F.col("spans").alias("__spans")), "__key", "left")
            .select(*plain, "__spans").mapInArrow(cut, schema))

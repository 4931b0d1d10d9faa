"""N-gram Jaccard join: prefix filtering in rare-first order.

Two texts link when the Jaccard similarity of their sets of k-word shingles reaches a
fraction.  Texts with equal sets are one *class*, known by a 64-bit signature, so exact
copies are never paired.  The join then runs over classes:

1. Two fixed-size sketches over the whole corpus, a filter of shingles that may occur twice
   and counts of those, order shingles rare first (ties by hash).  Any total order gives the
   same links; this one keeps frequent shingles out of prefixes.
2. The prefix of a class is its first size - required overlap + 1 shingles.  Shingles that
   occur once lead it and need no partner; the others are emitted with their positions.
3. Classes that share a prefix shingle are candidates.  First each class is paired with the
   lowest class of its shingle only (a star, so a group of n near copies costs n pairs, not
   n squared); candidates pass length, positional and suffix filters and are verified once,
   exactly, on whole texts.  What is left are shingles whose classes are in different
   components.  They go on in rounds: a few classes of each shingle, four times as many in
   every round, are paired with all its classes of other components, and then leave the
   shingle, as they have met everyone.  Links found in a round join components, so a group of
   near copies whose lowest one is unlike the others comes together in the first rounds; pairs
   inside one component cannot change it and are not formed.  No pair is verified twice.
4. Components of the verified links carry the smallest document id.

The suffix filter is a histogram of a set over 64 hash buckets: the L1 distance of two
histograms is a lower bound of the sets' symmetric difference.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsmith.llm.common import connected_components, merge_components, small_arrow_batches, stored, text_chars
from logsmith.llm.sketches import LEVEL_BITS, frequency_levels, holding, may_repeat, repeat_filter
from logsmith.llm.words import all_shingles, mix, shingle_sets, word_hashes

SHINGLE_WORDS = 5
#: Linked when NUMERATOR * union <= DENOMINATOR * intersection.
NUMERATOR, DENOMINATOR = 75, 100
BUCKETS = 64
#: Rows of one shingle that one salt holds on average before its rows are split further.
SALT_ROWS_LOG2 = 14


def _shingles(batch: pa.RecordBatch) -> np.ndarray:
    return all_shingles(*word_hashes(batch.column("text").to_pylist()), SHINGLE_WORDS)[0]


def _repeated_shingles(bits):
    def extract(batch: pa.RecordBatch) -> np.ndarray:
        shingles = _shingles(batch)
        return shingles[may_repeat(bits.value, shingles)]
    return extract


def signature(shingles: np.ndarray) -> int:
    """A signed 64-bit signature of a set of shingles, free of order."""
    total = int(np.add.reduce(mix(shingles), dtype=np.uint64)) if len(shingles) else 0
    return int(mix(np.array([total ^ len(shingles)], np.uint64))[0].astype(np.int64))


def _required(n, numerator: int = NUMERATOR, denominator: int = DENOMINATOR):
    """Least overlap of a set of n with any set it links with."""
    return -(-numerator * n // denominator)


def _class_rows(bits, levels):
    def rows(batches):
        bit, level = bits.value, levels.value
        seen: set[int] = set()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            out = {"n_shingles": [], "sig": [], "single": [], "histogram": [], "tokens": []}
            for s in shingle_sets(texts, SHINGLE_WORDS):
                sig = signature(s)
                tokens = histogram = single = None
                if len(s) and sig not in seen:  # one of a class's copies in this task speaks for it
                    seen.add(sig)
                    again = np.flatnonzero(may_repeat(bit, s))
                    # shingles that occur once come first in the order, and no other set has them
                    single = len(s) - len(again)
                    room = max(0, len(s) - _required(len(s)) + 1 - single)
                    lv = level[(s[again] >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)]
                    order = np.argsort(lv, kind="stable")[:room]
                    salts = np.maximum((lv[order].astype(np.int64) - 1) // 4 - SALT_ROWS_LOG2, 0)
                    # the salt's width rides in the low bits of the token, which stays a pure function of the shingle
                    tokens = ((s[again[order]] & ~np.uint64(31)) | salts.astype(np.uint64)).astype(np.int64)
                    histogram = np.bincount((s & np.uint64(BUCKETS - 1)).astype(np.int64),
                                            minlength=BUCKETS).astype(np.int32)
                out["n_shingles"].append(len(s))
                out["sig"].append(sig)
                out["tokens"].append(tokens)
                out["single"].append(single)
                out["histogram"].append(histogram)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(out["n_shingles"], pa.int64()), pa.array(out["sig"], pa.int64()),
                pa.array(out["single"], pa.int32()),
                pa.array(out["histogram"], pa.list_(pa.int32())), pa.array(out["tokens"], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "sig", "single", "histogram", "tokens"])
    return rows


def _pair_filter(x: Column, y: Column) -> Column:
    """Length and positional filters for a shingle at a place of two ordered sets.

    A place is struct(n_shingles, after), after the shingles behind this one in the order.  The
    first shingle that two sets share has all others they share behind it, so a link has one
    shingle that passes; later ones need not.
    """
    small, large = F.least(x["n_shingles"], y["n_shingles"]), F.greatest(x["n_shingles"], y["n_shingles"])
    bound = 1 + F.least(x["after"], y["after"])
    return ((small * DENOMINATOR >= large * NUMERATOR)
            & (bound * (NUMERATOR + DENOMINATOR) >= (x["n_shingles"] + y["n_shingles"]) * NUMERATOR))


def _suffix_filter(h_a: Column, h_b: Column, n_a: Column, n_b: Column) -> Column:
    """The histograms' L1 distance must not pass the largest symmetric difference of a link."""
    gap = F.aggregate(F.zip_with(h_a, h_b, lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return gap * (NUMERATOR + DENOMINATOR) <= (n_a + n_b) * (DENOMINATOR - NUMERATOR)


def _verify(batches):
    """(a, b, text_a, text_b) -> the pairs that link; each text is hashed once per run of its class."""
    known = {}
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        left, right = batch.column(2), batch.column(3).to_pylist()
        heads = [i for i in range(len(a)) if (i == 0 and a[i] not in known) or (i and a[i] != a[i - 1])]
        first_sets = shingle_sets([left[i].as_py() for i in heads], SHINGLE_WORDS)
        fresh = {a[i]: s for i, s in zip(heads, first_sets)}
        sets = {**known, **fresh}
        links = []
        for i, t in enumerate(shingle_sets(right, SHINGLE_WORDS)):
            s = sets[a[i]]
            if signature(s) != a[i] or signature(t) != b[i]:
                continue  # another text under a repeated id
            both = len(np.intersect1d(s, t, assume_unique=True))
            if NUMERATOR * (len(s) + len(t) - both) <= DENOMINATOR * both:
                links.append(i)
        if a:
            known = {a[-1]: sets[a[-1]]}
        yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in links], pa.int64()),
                                          "b": pa.array([b[i] for i in links], pa.int64())})


def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that pass the suffix filter, stored."""
    side = lambda x: classes.select(F.col("sig").alias(x), F.col("histogram").alias(f"h_{x}"),
                                    F.col("n_shingles").alias(f"n_{x}"))
    return stored(pairs.join(side("a"), "a").join(side("b"), "b")
                  .where(_suffix_filter(F.col("h_a"), F.col("h_b"), F.col("n_a"), F.col("n_b")))
                  .select("a", "b"), "ngram-pairs")


def _class_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(sig, text) of the classes in the one column of ``wanted``, in one pass over the documents."""
    # repeated rows of one id and text would repeat the fetch: one row of an id is enough, as
    # the check drops any text that is not the class's own
    chosen = stored(wanted.join(classes, "sig").select("sig", "doc_key"), "ngram-wanted")
    some = holding(docs.select(_doc_key().alias("doc_key"), "text"), "doc_key", chosen.select("doc_key")).dropDuplicates(["doc_key"])
    return stored(some.join(chosen, "doc_key").select("sig", "text"), "ngram-texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts link, by an exact check; stored."""
    one = lambda x: texts.select(F.col("sig").alias(x), F.col("text").alias(f"text_{x}"))
    with_texts = (pairs.join(one("b"), "b").join(one("a"), "a").select("a", "b", "text_a", "text_b"))
    return stored(with_texts.mapInArrow(_verify, "a long, b long").distinct(), "ngram-links")


def _doc_key() -> Column:
    """Finds a class's own text again: the id and a hash of the text."""
    return F.xxhash64("doc_id", "text")


def ngram_classes(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, doc_key, n_shingles and sig, the signature of its class.

    One row of a class in each task also carries the class's histogram and ordered prefix.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    texts = docs.select("text")
    bits = spark.sparkContext.broadcast(repeat_filter(texts, _shingles, text_chars(texts) // 6))
    levels = spark.sparkContext.broadcast(frequency_levels(texts, _repeated_shingles(bits)))
    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), _doc_key().alias("doc_key"))
                        .alias("doc_id"), "text")
    rows = stored(keyed.mapInArrow(
        _class_rows(bits, levels), "doc_id struct<doc_id:long,doc_key:long>, n_shingles long, sig long, single int, "
                                   "histogram array<int>, tokens array<long>"), "ngram-rows")
    return rows.select("doc_id.doc_id", "doc_id.doc_key", "n_shingles", "sig", "single", "histogram", "tokens")


def class_components(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) of the classes that link with another one."""
    # a class may speak in several tasks: its lowest document key is kept
    speakers = rows.where("tokens IS NOT NULL")
    classes = stored(speakers.groupBy("sig").agg(
        F.min("doc_key").alias("doc_key"), F.first("n_shingles").alias("n_shingles"),
        F.first("histogram").alias("histogram")), "ngram-classes")
    tokens = speakers.select("sig", "n_shingles", "single", F.posexplode("tokens").alias("pos", "token")).select(
        "token", F.expr("pmod(sig, shiftleft(1L, cast(token & 31 AS int)))").alias("salt"),
        "sig", F.struct(F.col("n_shingles").cast("int").alias("n_shingles"),
                        (F.col("n_shingles") - F.col("single") - F.col("pos") - 1).cast("int").alias("after")).alias("at"))
    group = Window.partitionBy("token", "salt")
    shared = (tokens.withColumn("low", F.min(F.struct("sig", "at")).over(group))
              .withColumn("high", F.max("sig").over(group)))
    # a salted shingle's rows stay even if alone in their salt
    shared = stored(shared.where((F.col("low.sig") != F.col("high")) | (F.col("token").bitwiseAND(31) > 0))
                    .drop("high"), "ngram-shared")

    def candidates(a: str, b: str) -> Column:
        return _pair_filter(F.col(a), F.col(b))

    near = (shared.where("sig != low.sig").where(candidates("at", "low.at"))
            .select(F.col("low.sig").alias("a"), F.col("sig").alias("b")))
    tops = (shared.where(F.col("token").bitwiseAND(31) > 0).select("token", "low").distinct()
            .withColumn("top", F.min("low").over(Window.partitionBy("token")))
            .where("low.sig != top.sig").where(candidates("low.at", "top.at"))
            .select(F.col("top.sig").alias("a"), F.col("low.sig").alias("b")))
    pairs = _filtered(near.union(tops).distinct(), classes)
    wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    if pairs.isEmpty():
        star = refused = pairs
    else:
        star = _verified(pairs, _class_texts(wanted, classes, docs))
        refused = stored(pairs.join(star, ["a", "b"], "left_anti"), "ngram-refused")
    part = stored(connected_components(star), "ngram-star-parts")
    open_rows = _open(shared.join(part, shared["sig"] == part["node"], "left")
                      .select("token", "sig", "at", F.coalesce("component", "sig").alias("part")).distinct())
    if open_rows.isEmpty():
        return part
    texts = _class_texts(open_rows.select("sig").distinct(), classes, docs)
    width = 1
    while not open_rows.isEmpty():
        # the lowest class of each of ``width`` hash groups of a shingle speaks in this round
        speakers = stored(open_rows.groupBy("token", F.pmod(F.xxhash64("sig"), F.lit(width)).alias("no")).agg(
            F.min(F.struct("sig", "part", "at")).alias("s")).select("token", "s"), "ngram-speakers")
        meet = (open_rows.join(speakers, "token").where(F.col("part") != F.col("s.part")).where(candidates("at", "s.at"))
                .select(F.least("sig", "s.sig").alias("a"), F.greatest("sig", "s.sig").alias("b")).distinct())
        pairs = _filtered(meet.join(refused, ["a", "b"], "left_anti"), classes)
        rest = open_rows.join(speakers.select("token", "s.sig"), ["token", "sig"], "left_anti")
        if not pairs.isEmpty():
            links = _verified(pairs, texts)
            refused = stored(refused.union(pairs.join(links, ["a", "b"], "left_anti")), "ngram-refused")
            if not links.isEmpty():
                part, renamed = merge_components(part, links)
                rest = (rest.join(renamed, rest["part"] == renamed["old"], "left")
                        .select("token", "sig", "at", F.coalesce("new", "part").alias("part")))
        open_rows = _open(rest)
        width *= 4
    return part


def _open(rows: DataFrame) -> DataFrame:
    """The rows (token, sig, at, part) of shingles whose classes are in more than one component."""
    rows = stored(rows, "ngram-labelled")
    mixed = (rows.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q"))
             .where("p != q").select("token"))
    return stored(rows.join(mixed, "token"), "ngram-open")


def _components(docs: DataFrame) -> DataFrame:
    """doc_id, doc_key, n_shingles, component_id, class_id of every input row."""
    rows = ngram_classes(docs)
    plain = rows.select("doc_id", "doc_key", "n_shingles", "sig")
    parts = class_components(rows, docs)
    linked = stored(plain.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("low_id"))
                    .join(parts, F.col("sig") == F.col("node"), "left")
                    .select("sig", F.coalesce("component", "sig").alias("part"), "low_id"), "ngram-parts")
    lowest = linked.groupBy("part").agg(F.min("low_id").alias("component_id"))
    named = stored(linked.join(lowest, "part").select("sig", "component_id"), "ngram-components")
    return plain.join(named, "sig", "left").select(
        "doc_id", "doc_key", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("sig").alias("class_id"))


def ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, class_id.

    component_id is the smallest doc_id reachable by links, its own included; class_id tells
    texts of equal sets.  Null, empty and blank texts have no shingles and link with nothing:
    their component_id is their own doc_id.  A text of fewer than five words is one shingle.
    Rows with a null doc_id link by their text; component_id is null only if no id is
    reachable.  Repeated rows and repeated ids give a row each.  An empty table gives no rows;
    other columns are ignored.
    """
    return _components(docs).drop("doc_key")


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id.

    All columns are kept.  Rows without words have no component and all stay.  Of rows that
    repeat the smallest id one stays, and of a component without any id one stays: the row of
    the lowest hash of id and text.
    """
    rows = _components(docs)
    # a component is known by its smallest id, or by its class when it has no id at all
    keepers = (rows.where("n_shingles > 0").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
               .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("class_id")).alias("class_id"))
               .agg(F.min("doc_key").alias("_key")).select("_key", F.lit(True).alias("_one")))
    wordless = rows.where("n_shingles = 0").select(F.col("doc_key").alias("_key"), F.lit(False).alias("_one")).distinct()
    keys = stored(keepers.union(wordless), "ngram-keepers")
    same = Window.partitionBy("_key").orderBy("_key")
    joined = docs.withColumn("_key", _doc_key()).join(keys, "_key").withColumn("_no", F.row_number().over(same))
    return joined.where("_no = 1 OR NOT _one").select(*docs.columns)

"""Approximate nearest neighbours by cross-polytope hashing.

A hash is a fast pseudo-random rotation of a vector's direction, three rounds of random signs
and a Hadamard transform, followed by the nearest signed axis: 2 * d buckets.  A table hashes
with one or more rotations together, as many as leave at most BUCKETS buckets to a point, and
there are TABLES tables.  Points are hashed in bands of length (half an octave each, length 1 in
the middle of one), as the largest inner products are not always the smallest angles.

A query probes, in each table, every bucket whose signed axes fall short of the query's nearest
ones by at most a reach (multiprobe by score).  Reaches are fitted, per band: the true
neighbours of at most CALIBRATION sampled queries, found by a scan of all points, tell how far
one has to go to meet a share RECALL of them.  The candidates collected are ranked by exact
inner products of the original vectors; a query that meets fewer than TOP + 1 is compared with
all points, in blocks.

Equal vectors are one point: a vector that a third of all rows share is hashed, compared and
ranked once.  Buckets are handled together in slots of about BLOCK points; a crowded slot is
split into blocks of points and queries over tasks, and nothing is cut off.  A bounded sample
of points gives each query a score that its result reaches at least, and the candidates of the
first table a higher one for the other tables, whose rank does not grow with the table.
Candidates below it, or behind TOP + 1 others of their block, cannot be in the result and are
not sent on, and a band whose longest vector cannot reach it is not probed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsmith.llm.common import small_arrow_batches, stored

TOP = 20
QUERY_STEP = 20
TABLES = 16
ROUNDS = 3
SEED = 14
#: Most buckets of a table for each of its points.
BUCKETS = 16
#: Points that one task compares with one group of queries of the same slot.
BLOCK = 8192
#: Points per dim in the sample that bounds scores from below, and queries per dim that fit the reaches.
SAMPLE = 2048
CALIBRATION = 128
#: Share of the sampled queries' true neighbours that the fitted reaches meet.
RECALL = 0.95
SLACK = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, scaled to keep lengths; a power of two columns."""
    d, step = x.shape[1], 1
    x = x.copy()
    while step < d:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), d)
        step *= 2
    return x / np.sqrt(d)


def width(dim: int) -> int:
    return 1 << int(np.ceil(np.log2(dim)))


def depth(dim: int, points: int) -> int:
    """Rotations that a table hashes with together."""
    k, axes = 1, 2 * width(dim)
    while axes ** (k + 1) <= BUCKETS * points:
        k += 1
    return k


def rotations(dim: int, n: int) -> np.ndarray:
    """Random signs by table, rotation and round; the first rotations are the same for every ``n``."""
    return np.stack([np.random.default_rng([SEED, dim, k]).choice([-1.0, 1.0], size=(TABLES, ROUNDS, width(dim)))
                     for k in range(n)], axis=1)


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """One pseudo-random rotation of vectors, padded with zeros."""
    out = np.zeros((len(x), signs.shape[1]))
    out[:, :x.shape[1]] = x
    for s in signs:
        out = hadamard(out * s)
    return out


def both_signs(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Coordinates of the rotated directions along each signed axis: axis a is 2 * a, its negative 2 * a + 1."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = rotated(x / np.linalg.norm(x, axis=1, keepdims=True), signs)
    return np.stack([y, -y], axis=2).reshape(len(y), -1)


def nearest_axes(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Nearest signed axis of each row, by table and rotation."""
    return np.stack([np.stack([both_signs(x, s).argmax(axis=1) for s in table], axis=1) for table in signs], axis=1)


def shortfalls(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """By row, table and rotation: how far each signed axis falls short of the nearest one."""
    y = np.stack([np.stack([both_signs(x, s) for s in table], axis=1) for table in signs], axis=1)
    return y.max(axis=3, keepdims=True) - y


def codes_of(axes: np.ndarray, n: int, dim: int) -> np.ndarray:
    """The buckets of the first ``n`` rotations' axes (last dimension) as numbers."""
    code = np.zeros(axes.shape[:-1], dtype=np.int64)
    for k in range(n):
        code = code * (2 * width(dim)) + axes[..., k]
    return code


def probed_codes(short: np.ndarray, n: int, reach: float) -> np.ndarray:
    """Buckets of one table within reach of one query; ``short`` by rotation and axis."""
    code, far = np.zeros(1, dtype=np.int64), np.zeros(1)
    for k in range(n):
        total = far[:, None] + short[k][None, :]
        i, axis = np.nonzero(total <= reach)
        code, far = code[i] * short.shape[1] + axis, total[i, axis]
    return code


def slots_of(code: np.ndarray, slots: int) -> np.ndarray:
    mixed = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(slots)).astype(np.int32)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in order, in double precision."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and vec of the rows that take part, with the vectors' dim, length and band of length."""
    vec = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    length = F.col("largest") * F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest"))))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(finite)
            .withColumn("largest", largest).where(F.col("largest") > 0).withColumn("length", length)
            .withColumn("band", F.floor(2 * F.log2("length") + 0.5).cast("int")).withColumn("dim", F.size("vec")).drop("largest"))


def _matrix(batch: pa.RecordBatch, rows: np.ndarray, dim: int) -> np.ndarray:
    return np.array(batch.column("vec").take(pa.array(rows)).flatten(), dtype=np.float64).reshape(len(rows), dim)


def _stacked(column, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, dtype=np.float64) for v in column]).reshape(len(column), dim)


def _hash_points(bands: dict):
    """mapInArrow function: a row for each point and table.  ``bands``: by dim and band the depth, slots, longest and reach."""
    def run(batches):
        signs = {dim: rotations(dim, max(b[0] for b in own.values())) for dim, own in bands.items()}
        for batch in batches:
            dims, band = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "band"))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                axes = nearest_axes(_matrix(batch, rows, int(dim)), signs[dim])
                for b in np.unique(band[rows]):
                    at = band[rows] == b
                    n, slots = bands[dim][b][:2]
                    code = codes_of(axes[at], n, int(dim)).reshape(-1)
                    take = pa.array(np.repeat(rows[at], TABLES))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("point").take(take), batch.column("dim").take(take), batch.column("band").take(take),
                         pa.array(np.tile(np.arange(TABLES, dtype=np.int32), at.sum())),
                         pa.array(slots_of(code, slots)), pa.array(code)], names=["point", "dim", "band", "tab", "slot", "code"])
    return run


def _floor(q: np.ndarray, margin: np.ndarray, short: np.ndarray, sample: tuple, bands: dict) -> np.ndarray:
    """A score for each query that TOP + 1 of its candidates reach, as far as the sample tells."""
    points, axes, band = sample
    if len(points) <= TOP:
        return np.full(len(q), -np.inf)
    n, reach = np.array([bands[b][0] for b in band]), np.array([bands[b][3] for b in band])
    met = np.zeros((len(q), len(points)), dtype=bool)
    for t in range(TABLES):
        far = short[:, t, 0][:, axes[:, t, 0]]
        for k in range(1, axes.shape[2]):
            far = np.where(n > k, far + short[:, t, k][:, axes[:, t, k]], far)
        met |= far <= reach
    scores = np.where(met, q @ points.T, -np.inf)
    return np.partition(scores, -TOP - 1, axis=1)[:, -TOP - 1] - margin


def _probe(bands: dict, sample: dict):
    """mapInArrow function: each query's probed buckets, a row for each band, table and slot."""
    def run(batches):
        signs = {dim: rotations(dim, max(b[0] for b in own.values())) for dim, own in bands.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            ids = batch.column("point").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                q = _matrix(batch, rows, int(dim))
                short = shortfalls(q, signs[dim])
                own = np.linalg.norm(q, axis=1)
                margin = SLACK * own * max(b[2] for b in bands[dim].values())
                floor = _floor(q, margin, short, sample[dim], bands[dim])
                for i, row in enumerate(rows):
                    out = []
                    for b, (n, slots, longest, reach) in bands[dim].items():
                        if floor[i] > longest * own[i]:
                            continue
                        for t in range(TABLES):
                            code = probed_codes(short[i, t], n, reach)
                            slot = slots_of(code, slots)
                            out += [(b, t, s, code[slot == s]) for s in np.unique(slot)]
                    if out:
                        band, tab, slot, codes = zip(*out)
                        same = lambda x, kind: pa.array([x] * len(out), type=kind)
                        yield pa.RecordBatch.from_arrays(
                            [same(ids[row], pa.int64()), same(dim, pa.int32()), pa.array(band, pa.int32()), pa.array(tab, pa.int32()),
                             pa.array(slot, pa.int32()), pa.array(codes, pa.list_(pa.int64())), same(floor[i], pa.float64()),
                             same(margin[i], pa.float64())],
                            names=["query", "dim", "band", "tab", "slot", "codes", "floor", "margin"])
    return run


def _true_neighbours(asked: dict):
    """mapInPandas function: the TOP + 1 nearest points of each sampled query in one partition.
    ``asked``: by dim the queries' numbers, vectors and scores that their neighbours reach."""
    def run(batches):
        kept: dict[int, list] = {}
        for pdf in batches:
            for dim, (numbers, q, floor) in asked.items():
                some = pdf[pdf["dim"] == dim]
                if not len(some):
                    continue
                vectors, ids = _stacked(some["vec"], dim), some["point"].to_numpy()
                scores = q @ vectors.T
                for i in range(len(q)):
                    at = np.flatnonzero(scores[i] >= floor[i])
                    if len(at):
                        old = kept.get(numbers[i], [])
                        new = old + [(scores[i, j], ids[j], vectors[j], band) for j, band in zip(at, some["band"].to_numpy()[at])]
                        kept[numbers[i]] = sorted(new, key=lambda r: (-r[0], r[1]))[:TOP + 1]
        rows = [(n, *r) for n, found in kept.items() for r in found]
        yield pd.DataFrame(rows, columns=["number", "score", "point", "vec", "band"])
    return run


def _sampled(df: DataFrame, counts: dict, size: int) -> dict:
    """At most ``size`` rows (point, vec, band) of each dim, chosen by hash; few rows more than that are moved."""
    if not counts:
        return {}
    share = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 40))
    bound = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, min(1 << 40, (size << 42) // n + 1))])
    by_dim = Window.partitionBy("dim").orderBy("share", "first")
    rows = (df.withColumn("share", share).where(F.col("share") < bound[F.col("dim")])
            .withColumn("n", F.row_number().over(by_dim)).where(F.col("n") <= size)
            .select("dim", "point", "vec", "band").collect())
    return {d: [r for r in rows if r["dim"] == d] for d in counts}


def _fitted(points: DataFrame, searched: DataFrame) -> tuple[dict, dict]:
    """By dim and band the depth, slots, longest vector and reach; by dim the sample with its axes and bands."""
    sizes = points.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).collect()
    counts = {d: sum(r["n"] for r in sizes if r["dim"] == d) for d in sorted({r["dim"] for r in sizes})}
    some = _sampled(points, counts, SAMPLE)
    queries = dict(searched.groupBy("dim").count().collect())
    chosen = _sampled(searched, queries, CALIBRATION)
    asked, vectors = {}, {d: np.array([r["vec"] for r in some[d]]) for d in counts}
    numbered = [(d, r) for d in sorted(chosen) for r in chosen[d]]
    for d in chosen:
        q = np.array([r["vec"] for r in chosen[d]])
        floor = np.full(len(q), -np.inf)
        if len(vectors[d]) > TOP:
            floor = np.partition(q @ vectors[d].T, -TOP - 1, axis=1)[:, -TOP - 1]
            floor -= SLACK * np.linalg.norm(q, axis=1) * max(r["longest"] for r in sizes if r["dim"] == d)
        asked[d] = [i for i, (e, _) in enumerate(numbered) if e == d], q, floor
    near = points.select("point", "dim", "band", "vec").mapInPandas(
        _true_neighbours(asked), "number int, score double, point long, vec array<double>, band int")
    for group in (["number", F.pmod(F.xxhash64("point"), F.lit(64))], ["number"]):
        best = Window.partitionBy(*group).orderBy(F.col("score").desc(), "point")
        near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= TOP + 1)
    truth = near.collect()                        # at most CALIBRATION * (TOP + 1) rows per dim

    bands: dict[int, dict] = {d: {} for d in counts}
    needed: dict[tuple, list] = {}
    signs = {d: rotations(d, max(depth(d, r["n"]) for r in sizes if r["dim"] == d)) for d in counts}
    size = {(r["dim"], r["band"]): r["n"] for r in sizes}
    for number, (d, query) in enumerate(numbered):
        found = [r for r in truth if r["number"] == number and r["point"] != query["point"]]
        if found:
            short = shortfalls(np.array([query["vec"]]), signs[d])[0]
            axes = nearest_axes(np.array([r["vec"] for r in found]), signs[d])
            for r, own in zip(found, axes):
                n = depth(d, size[d, r["band"]])
                far = sum(np.take_along_axis(short[:, k], own[:, k:k + 1], 1)[:, 0] for k in range(n))
                needed.setdefault((d, r["band"]), []).append(far.min())
    for r in sorted(sizes, key=lambda r: (r["dim"], r["band"])):
        d, b = r["dim"], r["band"]
        reach = np.quantile(needed[d, b], RECALL, method="higher") if (d, b) in needed else 0.0
        bands[d][b] = depth(d, r["n"]), -(-r["n"] // BLOCK), r["longest"], float(reach) + 1e-12
    return bands, {d: (vectors[d], nearest_axes(vectors[d], signs[d]), [r["band"] for r in some[d]]) for d in counts}


def _rank_block(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The best TOP + 1 candidates of each query of a block in one block of points."""
    none = np.empty(0, np.int64)
    out = [(none, none, none, np.empty(0))]
    if len(points) and len(queries):
        dim = len(points["vec"].iloc[0])
        points = points.sort_values("code", kind="stable")
        p_code, p_ids, p_first = (points[c].to_numpy() for c in ("code", "point", "first"))
        all_p, all_q = _stacked(points["vec"], dim), _stacked(queries["vec"], dim)
        q_ids, floors = queries["query"].to_numpy(), queries["floor"].to_numpy()
        lists = [np.asarray(c, dtype=np.int64) for c in queries["codes"]]
        q_code, q_at = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(c) for c in lists])
        order = np.argsort(q_code, kind="stable")
        q_code, q_at = q_code[order], q_at[order]
        codes = np.intersect1d(p_code, q_code)
        edges = [np.searchsorted(x, codes, side=s) for x in (p_code, q_code) for s in ("left", "right")]
        for p_from, p_to, q_from, q_to in zip(*edges):
            p, qi = all_p[p_from:p_to], q_at[q_from:q_to]
            scores, floor = all_q[qi] @ p.T, floors[qi]
            if len(p) > TOP + 1:
                lengths = np.linalg.norm(all_q[qi], axis=1) * np.linalg.norm(p, axis=1).max()
                floor = np.maximum(floor, np.partition(scores, -TOP - 1, axis=1)[:, -TOP - 1] - SLACK * lengths)
            i, j = np.nonzero(scores >= floor[:, None])
            if len(i):
                out.append((q_ids[qi[i]], p_ids[p_from + j], p_first[p_from + j], _exact(all_q[qi[i]], p[j])))
    found = pd.DataFrame({n: np.concatenate(c) for n, c in zip(("query", "point", "first", "score"), zip(*out))})
    found = found.sort_values(["query", "score", "first"], ascending=[True, False, True])
    return found[found.groupby("query").cumcount() <= TOP]


def _compare(hashed: DataFrame, probed: DataFrame, points: DataFrame, searched: DataFrame) -> DataFrame:
    """(query, point, first, score): candidates of the probed buckets, by blocks of a slot's points and queries."""
    bucket = ["dim", "band", "tab", "slot"]
    count = lambda df, n: df.groupBy(bucket).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(n))
    blocks = stored(count(hashed, "p_blocks").join(count(probed, "q_blocks"), bucket), "ann-blocks")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = (hashed.join(blocks, bucket).select(*bucket, "code", "point", place("point", "p_blocks").alias("p"), spread("q_blocks").alias("q"))
            .join(points.select("point", "first", "vec"), "point"))
    right = (probed.join(blocks, bucket).select(*bucket, "codes", "floor", "query", place("query", "q_blocks").alias("q"), spread("p_blocks").alias("p"))
             .join(searched.select(F.col("point").alias("query"), "vec"), "query"))
    group = [*bucket, "p", "q"]
    return left.groupBy(group).cogroup(right.groupBy(group)).applyInPandas(
        _rank_block, "query long, point long, first long, score double")


def nearest_neighbours(embeddings: DataFrame, query_step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the TOP nearest found of each query, nearest first.

    Queries are the rows whose vec_id is divisible by ``query_step``; candidates are all other
    rows.  Nearness is the inner product; ties go to the smaller vec_id.  Null, empty and zero
    vectors, vectors with null or non-finite components and rows with a null vec_id take no
    part; vectors of different lengths are never compared (dims are few: each has an index of
    its own).  A row that repeats a vec_id is a row of its own unless it repeats the vector too;
    rows of a query's own vec_id are not among its results.  With no more than TOP other vectors
    all are returned.  Extra columns are ignored.
    """
    spark = embeddings.sparkSession
    small_arrow_batches(spark)
    rows = stored(valid_vectors(embeddings).dropDuplicates(["vec_id", "vec"])
                  .withColumn("key", F.xxhash64("vec")), "ann-rows")
    # the smallest ids of equal vectors are all that a result can show; the limit is partial before the shuffle
    by_vector = Window.partitionBy("key", "vec").orderBy("vec_id")
    points = stored(rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= TOP + 1)
                    .groupBy("key", "vec", "dim", "band", "length")
                    .agg(F.min("vec_id").alias("first"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
                    .withColumn("point", F.monotonically_increasing_id()), "ann-points")
    asked = rows.where(F.pmod("vec_id", F.lit(query_step)) == 0)
    searched = stored(asked.select("key", "vec").distinct().join(
        points.select("key", "vec", "dim", "band", "point", "first"), ["key", "vec"]), "ann-queries")
    bands, sample = _fitted(points, searched)

    hashed = stored(points.select("point", "dim", "band", "vec").mapInArrow(
        _hash_points(bands), "point long, dim int, band int, tab int, slot int, code long"), "ann-hashed")
    probed = stored(searched.select("point", "dim", "vec").mapInArrow(
        _probe(bands, sample), "query long, dim int, band int, tab int, slot int, codes array<long>, floor double, margin double"), "ann-probed")
    table = lambda df, first: df.where((F.col("tab") == 0) == first)
    found = stored(_compare(table(hashed, True), table(probed, True), points, searched), "ann-first")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "first")
    reached = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= TOP + 1)
               .groupBy("query").agg(F.min("score").alias("reached"), F.max("n").alias("n")).where(F.col("n") == TOP + 1))
    raised = stored(table(probed, False).join(reached.drop("n"), "query", "left").withColumn(
        "floor", F.greatest("floor", F.col("reached") - F.col("margin"))), "ann-raised")
    found = stored(found.unionByName(_compare(table(hashed, False), raised, points, searched)).distinct(), "ann-found")

    # queries that met too few points are compared with all of them: one bucket for each dim
    met = found.groupBy("query").agg(F.count(F.lit(1)).alias("met"))
    lacking = stored(searched.join(met, searched["point"] == met["query"], "left")
                     .where(F.coalesce("met", F.lit(0)) <= TOP).select("point", "dim"), "ann-lacking")
    if not lacking.isEmpty():
        one = [F.lit(0).alias("band"), F.lit(-1).alias("tab"), F.lit(0).alias("slot")]
        whole = _compare(points.select("point", "dim", *one, F.lit(0).cast("long").alias("code")),
                         lacking.select(F.col("point").alias("query"), "dim", *one, F.array(F.lit(0).cast("long")).alias("codes"),
                                        F.lit(float("-inf")).alias("floor")), points, searched)
        found = found.unionByName(whole).distinct()

    ranked = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= TOP + 1)
              .join(points.select("point", "ids"), "point")
              .groupBy("query").agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(
                  (-F.col("score")).alias("minus"), i.alias("vec_id"))))).alias("near")))
    ranked = stored(ranked.select("query", F.slice(F.array_sort("near"), 1, TOP + 1).alias("near")), "ann-ranked")

    ids = stored(asked.select("vec_id", "key", "vec").join(points.select("key", "vec", "point"), ["key", "vec"])
                 .select(F.col("vec_id").alias("query_id"), F.col("point").alias("query")), "ann-ids")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, TOP)
    return (ids.join(ranked, "query").select("query_id", F.posexplode(others).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                    (-F.col("x.minus")).alias("score")))

"""K-Means with deterministic centres (M4-M8, M12, M13), as aggregations.

Seeding is farthest first: the client of the smallest key, then again and again the client that
is farthest from all centres so far (ties by key).  Lloyd steps move every centre to the mean of
its clients until no client changes cluster.  A step is one pass over the client table with the
k centres as literals, and k rows of sums come back; no result depends on the number of cores or
partitions, up to the last bits of a sum of doubles.

Cost and silhouette have a closed form in the moments of the clusters (count, sum of vectors,
sum of squared lengths): the mean squared distance of a client to a cluster follows from them,
so no pair of clients is ever formed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled features are rounded to so many places, so that equal clients have equal vectors everywhere.
PLACES = 9


@dataclass(frozen=True)
class Centres:
    """A fitted clustering: centres in scaled space, as many steps as it took, and if it came to rest."""

    centres: tuple[tuple[float, ...], ...]
    steps: int
    at_rest: bool

    def assign(self, scaled: DataFrame) -> DataFrame:
        """``scaled`` with ``cluster``, the nearest centre (ties: the first), and ``centroid_distance``."""
        return (scaled.withColumn("_nearest", _nearest(self.centres)).withColumn("cluster", F.col("_nearest.no"))
                .withColumn("centroid_distance", F.sqrt("_nearest.d2")).drop("_nearest"))


def scaled_features(features: DataFrame, columns: list[str]) -> DataFrame:
    """``features`` with an array ``features`` of the columns at mean 0 and sample deviation 1.

    A NULL counts as 0, a column without deviation is 0 throughout.  One pass for the means and
    deviations (one row, broadcast).
    """
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    stats = features.agg(*[F.avg(v).alias(f"m_{c}") for c, v in filled.items()],
                         *[F.stddev_samp(v).alias(f"s_{c}") for c, v in filled.items()])

    def scaled(c: str) -> Column:
        value = F.try_divide(filled[c] - F.col(f"m_{c}"), F.col(f"s_{c}"))
        return F.round(F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0)), PLACES) + 0.0
    joined = features.crossJoin(F.broadcast(stats))
    return joined.withColumn("features", F.array(*[scaled(c) for c in columns])).select(*features.columns, "features")


def _nearest(centres) -> Column:
    """struct(d2, no) of the centre nearest to ``features``; NULL if there are none.

    The centres are one constant and the expression one text: a step then costs the driver
    little more than its job.
    """
    constant = json.dumps([[float(v) for v in c] for c in centres])
    return F.expr(f"""array_min(transform(from_json('{constant}', 'array<array<double>>'), (c, i) -> struct(
        aggregate(zip_with(features, c, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v) AS d2, i AS no)))""")


def farthest_first(scaled: DataFrame, k: int, key: str = "ip") -> list[tuple[float, ...]]:
    """Up to ``k`` seeds; fewer if there are fewer different vectors.  One aggregation per seed."""
    first = scaled.agg(F.min_by("features", key).alias("x")).first().x
    if first is None:
        return []
    seeds = [tuple(first)]
    while len(seeds) < k:
        near = F.struct((-_nearest(seeds)["d2"]).alias("d2"), F.col(key).alias("key"))
        # the largest distance, and of those that have it the smallest key
        far = (scaled.select("features", near.alias("near"))
               .agg(F.min("near").alias("at"), F.min_by("features", "near").alias("x")).first())
        if far["at"].d2 >= 0:
            break
        seeds.append(tuple(far.x))
    return seeds


def fit(scaled: DataFrame, k: int = 5, max_steps: int = 20, key: str = "ip") -> Centres:
    """Centres after Lloyd steps from farthest-first seeds; ``scaled`` should be a stored table.

    A step assigns, counts the clients that changed cluster and sums each cluster up, in one
    pass; it stops when none changed, or after ``max_steps``.  A cluster that lost all its
    clients keeps its centre.
    """
    centres = farthest_first(scaled, k, key)
    if not centres:
        return Centres((), 0, True)
    size, before = len(centres[0]), []
    for step in range(max_steps):
        at, was = _nearest(centres)["no"], _nearest(before)["no"]
        sums = (scaled.select(at.alias("no"), (~at.eqNullSafe(was)).alias("moved"), "features").groupBy("no")
                .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("moved").cast("long")).alias("moved"),
                     *[F.expr(f"sum(features[{i}]) AS x{i}") for i in range(size)])).collect()   # k rows
        if not sum(r.moved for r in sums):
            return Centres(tuple(centres), step, True)
        before, centres = centres, list(centres)
        for r in sums:
            centres[r.no] = tuple(r[f"x{i}"] / r.n for i in range(size))
    return Centres(tuple(centres), max_steps, False)


def quality(clustered: DataFrame, k: int) -> DataFrame:
    """M5 + M13: one row k, training_cost, silhouette (squared distances), from the moments of the clusters.

    The cost is the sum of squared distances to the mean of the own cluster.  A client alone in
    its cluster has silhouette 0; with one cluster in all the silhouette is NULL.
    """
    size = clustered.select(F.size("features").alias("n")).first()
    length = size.n if size else 0
    square = F.aggregate(F.transform("features", lambda v: v * v), F.lit(0.0), lambda s, v: s + v)
    moments = (clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"),
        *[F.sum(F.col("features")[i]).alias(f"x{i}") for i in range(length)])).collect()              # k rows
    spark = clustered.sparkSession
    if not moments:
        return spark.createDataFrame([(k, 0.0, None)], "k int, training_cost double, silhouette double")
    sums = {m.cluster: [m[f"x{i}"] for i in range(length)] for m in moments}
    cost = sum(m.q - sum(v * v for v in sums[m.cluster]) / m.n for m in moments)
    if len(moments) == 1:
        return spark.createDataFrame([(k, float(cost), None)], "k int, training_cost double, silhouette double")

    def mean_distance(m, own: bool) -> Column:
        dot = F.aggregate(F.zip_with("features", F.lit([float(v) for v in sums[m.cluster]]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        total = m.n * F.col("sq") + F.lit(float(m.q)) - 2 * dot
        return F.greatest(total / F.lit(float(max(m.n - 1, 1) if own else m.n)), F.lit(0.0))
    points = clustered.withColumn("sq", square)
    own = others = F.lit(None).cast("double")
    for m in moments:
        mine = F.col("cluster") == m.cluster
        own = F.when(mine, F.lit(0.0) if m.n == 1 else mean_distance(m, True)).otherwise(own)
        others = F.least(others, F.when(~mine, mean_distance(m, False)))
    alone = F.col("cluster").isin([m.cluster for m in moments if m.n == 1])
    score = F.when(alone, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return points.select("cluster", own.alias("a"), others.alias("b")).agg(F.avg(score).alias("silhouette")).select(
        F.lit(k).alias("k"), F.lit(float(cost)).alias("training_cost"), "silhouette")

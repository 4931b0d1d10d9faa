"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree
(DataFrame functions only).

1. Sizes are word counts.  Target words per source come from its weight, never above
   ``max_epochs`` times its size; the excess is reshared by weight (water filling).
2. Each source's documents fall into blocks by hash.  A target is whole passes over the
   source (epochs) plus, through all blocks in a permuted order, the documents that still fit
   into what is left; those of the block that what is left ends in go largest first.
3. The drawn blocks of all sources are dealt to output shards by a binary tree.  At each
   node every drawn block goes left with the probability places left / blocks left
   (selection sampling), which makes the counts per source exactly multivariate
   hypergeometric; only counts per (node, source) travel, never blocks or documents.
4. A shard's share of a source is a run of that source's permuted draws, so shards are
   disjoint; inside a shard the order is a hash.

All randomness is a hash of the seed and the data: reruns agree, on any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsmith.llm.common import WORD_PATTERN, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SHARDS = 16
#: Blocks over all sources, whatever the corpus size; a block then holds that share of the words.
BLOCKS = 1 << 17
SEED = 20_011


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                   share: float = 1.0) -> DataFrame:
    """(source, source_size) -> the same with ``weight`` and ``target``.

    Sources by code point, null last, take the weights in turn.  The target of a source is
    min(max_epochs * size, level * weight), with the one level at which the targets add up
    to ``share`` of all words.  The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    all_rows = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    named = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if exactly the sources before this one are held at their caps
    level = ((F.sum("source_size").over(all_rows) * share
              - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    leveled = (named.withColumn("level", level).withColumn("n", F.row_number().over(by_cap))
               .withColumn("free", F.col("cap") >= F.col("level") * F.col("weight")))
    first = F.min(F.when(F.col("free"), F.struct("n", "level"))).over(all_rows)
    return leveled.withColumn("first", first).select(
        "source", "source_size", "weight",
        F.when(F.col("first").isNull() | (F.col("n") < F.col("first.n")), F.col("cap").cast("double"))
        .otherwise(F.col("first.level") * F.col("weight")).alias("target"))


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _split(quotas: Column, node: Column, left_total: Column) -> Column:
    """How many of each source's blocks go left: a multivariate hypergeometric draw.

    ``quotas`` is an array of struct(source_no, n).  Blocks are gone through once, source by
    source; each goes left with probability (places left) / (blocks left).
    """
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda s, q: s + q["n"])

    def one_source(state: Column, q: Column) -> Column:
        def one_block(s: Column, i: Column) -> Column:
            goes = _uniform(F.lit(SEED), node, q["source_no"], i) * s["blocks"] < s["places"]
            return F.struct((s["blocks"] - 1).alias("blocks"),
                            (s["places"] - goes.cast("long")).alias("places"),
                            (s["taken"] + goes.cast("long")).alias("taken"))
        start = F.struct(state["blocks"].alias("blocks"), state["places"].alias("places"),
                         F.lit(0).cast("long").alias("taken"))
        steps = F.when(q["n"] > 0, F.sequence(F.lit(1).cast("long"), q["n"])).otherwise(
            F.array().cast("array<bigint>"))
        end = F.aggregate(steps, start, one_block)
        return F.struct(end["blocks"].alias("blocks"), end["places"].alias("places"),
                        F.concat(state["left"], F.array(end["taken"])).alias("left"))

    begin = F.struct(total.alias("blocks"), left_total.alias("places"),
                     F.array().cast("array<bigint>").alias("left"))
    return F.aggregate(quotas, begin, one_source)["left"]


def split_quotas(quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(source_no, n drawn blocks) -> (shard, source_no, n): the leaves of the splitting tree.

    A node covers a run of shards; its left half gets a number of blocks in proportion to
    its shards.  One row per node holds the counts of its sources.
    """
    level = stored(quotas.agg(F.array_sort(F.collect_list(F.struct("source_no", "n"))).alias("quotas")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("count"), "quotas"), "mix-level")
    half = F.floor(F.col("count") / 2).cast("int")
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda s, q: s + q["n"])
    places = F.floor((total * half + F.floor(F.col("count") / 2)) / F.col("count")).cast("long")
    keep = lambda sign: F.zip_with("quotas", "left", lambda q, x: F.struct(
        q["source_no"].alias("source_no"), (x if sign else q["n"] - x).alias("n")))
    width = shards
    while width > 1:
        node = F.xxhash64("first", "count")
        parted = level.where("count > 1").withColumn("left", _split(F.col("quotas"), node, places))
        halves = parted.select(F.inline(F.array(
            F.struct("first", half.alias("count"), keep(True).alias("quotas")),
            F.struct((F.col("first") + half).alias("first"), (F.col("count") - half).alias("count"),
                     keep(False).alias("quotas")))))
        level = stored(halves.union(level.where("count = 1")), "mix-level")
        width = width - width // 2
    return level.select(F.col("first").alias("shard"), F.inline("quotas"))


def _fill(ranked: DataFrame, items: DataFrame, rests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents that fill each source's rest: (source_no, block, limit), blocks whose documents
    of up to ``limit`` words are taken, and (source_no, block, content), single documents of others.

    ``ranked`` has the blocks with their rank, ``items`` the documents with their words.  A round
    takes all documents that may fit, block by block, up to the block that goes beyond the room,
    there the largest first, and goes on behind that block with the room left, until no document
    of a later block fits.  What was passed over is larger than the room, which only shrinks.
    """
    items = stored(items.join(ranked, ["source_no", "block"]).where("words > 0"), "mix-items")
    state = stored(rests.select("source_no", F.col("rest").alias("room"), F.lit(0).cast("long").alias("after")), "mix-room")
    limits = stored(items.select("source_no", "block", F.lit(0.0).alias("limit")).limit(0), "mix-limits")
    singles = stored(items.select("source_no", "block", "content").limit(0), "mix-singles")
    by_rank = Window.partitionBy("source_no").orderBy("rank")
    while True:
        may_fit = items.join(state, "source_no").where("rank > after AND words <= room")
        blocks = (may_fit.groupBy("source_no", "block", "rank", "room").agg(F.sum("words").alias("block_size"))
                  .withColumn("upto", F.sum("block_size").over(by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                  .withColumn("boundary", F.min(F.when(F.col("upto") > F.col("room"), F.col("rank"))).over(
                      Window.partitionBy("source_no"))))
        blocks = stored(blocks, "mix-fill-blocks")
        if blocks.isEmpty():
            return limits, singles
        limits = limits.union(blocks.where("boundary IS NULL OR rank < boundary").select(
            "source_no", "block", F.col("room").alias("limit")))
        ends = blocks.where("rank = boundary").select(
            "source_no", "block", F.col("rank").alias("after"), (F.col("room") - (F.col("upto") - F.col("block_size"))).alias("left"))
        fits = F.aggregate(
            F.array_sort(F.collect_list(F.struct((-F.col("words")).alias("minus"), "content"))),
            F.struct(F.max("left").alias("room"), F.array().cast("array<bigint>").alias("chosen")),
            lambda s, d: F.when(s["room"] + d["minus"] >= 0, F.struct(
                (s["room"] + d["minus"]).alias("room"),
                F.concat(s["chosen"], F.array(d["content"])).alias("chosen"))).otherwise(s))
        fitted = (items.drop("rank").join(ends, ["source_no", "block"]).where("words <= left")
                  .groupBy("source_no").agg(fits.alias("fitted")))
        state = stored(ends.join(fitted, "source_no", "left").select(
            "source_no", "block", F.coalesce("fitted.room", "left").alias("room"), "after", "fitted.chosen"), "mix-room")
        singles = singles.union(state.select("source_no", "block", F.explode("chosen").alias("content")))
        state = state.select("source_no", "room", "after")


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
             shards: int = SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """How often, and into which shards, each document goes.

    Rows (doc_id, content, size, source, source_size, target, taken, shards, copies): one for
    each different (doc_id, source, text), ``copies`` such input rows; ``content`` is its
    64-bit hash, ``shards`` lists a shard for each time it is drawn and ``taken`` is size
    times draws, per input row.  Null or empty text has size 0 and is not drawn.  A null
    source is a source of its own.  Repeated rows are one unit, so each is drawn as often as
    the others.  An empty table gives no rows; other columns are ignored.
    """
    units = (docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                         F.xxhash64("doc_id", "source", "text").alias("content"))
             .groupBy("doc_id", "source", "size", "content").agg(F.count(F.lit(1)).alias("copies")))
    units = stored(units, "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    targets = (source_targets(sizes, weights, max_epochs)
               .withColumn("source_no", F.row_number().over(by_name).cast("long"))
               .withColumn("blocks", F.greatest(F.lit(1), F.ceil(
                   F.col("source_size") * blocks / F.greatest(F.lit(1), F.sum("source_size").over(Window.partitionBy())))).cast("long"))
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    targets = stored(targets, "mix-targets")

    # one row per source: broadcasting it is left to Spark's own size check
    placed = units.join(targets, units["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "content"), F.col("blocks")))
    words = F.col("size") * F.col("copies")
    # blocks of a source in permuted order
    order = Window.partitionBy("source_no").orderBy(F.xxhash64(F.lit(SEED + 1), "source_no", "block"), "block")
    ranked = (placed.groupBy("source_no", "block", "epochs").agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("rank", F.row_number().over(order).cast("long")).drop("rows"))
    ranked = stored(ranked, "mix-ranked")
    limits, singles = _fill(ranked.select("source_no", "block", "rank"), placed.select("source_no", "block", "content", words.alias("words")),
                            targets.select("source_no", "rest"))
    # draws of a block: its epochs, and one more if it is drawn whole or in part for the rest
    last = limits.unionByName(singles.select("source_no", "block", F.lit(0.0).alias("limit")).distinct())
    drawn = ranked.join(last, ["source_no", "block"], "left").withColumn(
        "draws", F.col("epochs") + F.col("limit").isNotNull().cast("long"))
    upto_rank = Window.partitionBy("source_no").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    drawn = drawn.withColumn("last_rank", F.count("limit").over(upto_rank))
    drawn = stored(drawn.withColumn("passed", F.count(F.lit(1)).over(Window.partitionBy("source_no"))), "mix-blocks")

    quotas = drawn.groupBy("source_no").agg(F.sum("draws").cast("long").alias("n"))
    leaf_order = Window.partitionBy("source_no").orderBy("shard")
    leaves = (split_quotas(quotas, shards).where("n > 0")
              .withColumn("upto", F.sum("n").over(leaf_order)))
    runs = leaves.groupBy("source_no").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("runs"))
    # draw number of a block in pass e: e whole passes before it, then its rank among the pass's blocks
    def shard_of(e: Column) -> Column:
        rank = F.when(e < F.col("epochs"), F.col("rank")).otherwise(F.col("last_rank"))
        return F.filter("runs", lambda r: r["upto"] >= e * F.col("passed") + rank)[0]["shard"]

    dealt = drawn.join(runs, "source_no", "left").withColumn("block_shards", F.when(
        F.col("draws") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("draws") - 1), shard_of))
        .otherwise(F.array().cast("array<int>")))
    dealt = stored(dealt.select("source_no", "block", "limit", "block_shards"), "mix-dealt")
    chosen = singles.select("content", F.lit(True).alias("fills"))

    out = placed.join(dealt, ["source_no", "block"]).join(chosen, "content", "left")
    draws = F.when(F.col("size") == 0, 0).otherwise(F.col("epochs") + (
        F.coalesce(words <= F.col("limit"), F.lit(False)) | F.coalesce("fills", F.lit(False))).cast("long"))
    return out.withColumn("draws", draws.cast("int")).select(
        "doc_id", "content", "size", "source", "source_size", "target",
        (F.col("size") * F.col("draws")).alias("taken"),
        F.slice("block_shards", F.lit(1), F.col("draws")).alias("shards"), "copies")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: ``docs`` rows repeated as drawn, with ``shard`` and ``position`` added
    at the end (columns of those names are replaced).

    ``position`` is a hash that orders a shard's rows; sort by it within a shard when writing.
    """
    plan = mix_plan(docs, **options).where("size(shards) > 0").select(
        F.col("content").alias("_content"), F.posexplode("shards").alias("_draw", "_shard"))
    keyed = docs.withColumn("_content", F.xxhash64("doc_id", "source", "text"))
    mixed = keyed.drop("shard", "position").join(stored(plan, "mix-plan"), "_content")
    return mixed.withColumn("shard", F.col("_shard")).withColumn(
        "position", F.xxhash64(F.lit(SEED + 2), "_content", "_draw")).drop("_content", "_draw", "_shard")

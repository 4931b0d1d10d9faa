"""Secret scans with corpus-wide ownership frequency.

1. Three patterns find spans in each text, by built-in functions: every match is put between
   two marks, the text is split at the marks, and running lengths of the pieces are places.
2. The values of those spans and other long mixed tokens are candidates.  Only their hashes
   leave the scan, never the secret itself.
3. Candidate hashes are counted by distinct repositories and owners: (hash, owner, repository)
   first, then (hash, owner), then hash, each a partial aggregation, so a value copied into a
   third of all rows never meets in one task.
4. A value that many owners or many repositories hold is a copied example.  A value of one
   owner that looks like a credential is live: its place is added as a span of its own.

Hashes with more than a 1,000th of all occurrences (so at most 1,000 of them) are judged by a
broadcast join; all others by a shuffled join whose largest group that share bounds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsmith.llm.common import let, stored

# Patterns and least lengths of the three base kinds, in the order of the kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "live")
LIVE = KINDS.index("live")

#: Any other token of this shape is a candidate too.
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
#: A live-looking value has a letter, a digit and this many different characters.
DISTINCT_CHARS = 8
#: Held by so many owners, or in so many repositories, a value is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 4, 10
#: A hash with at least 1 / HOT_PARTS of all occurrences is hot: at most HOT_PARTS hashes are.
HOT_PARTS = 1000

_MARK, _STAND_IN, _BLOCK = "\x01", "\x02", 256


def _running(lengths: Column, first: Column) -> Column:
    """``first`` plus the sum of the lengths before each place."""
    return F.aggregate(
        lengths, F.struct(first.alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"])


def _places(lengths: Column) -> Column:
    """The sum of the lengths before each place, block by block: appending to an array copies it."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))

    def joined(parts: Column) -> Column:
        sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x))
        return let(_running(sums, F.lit(0)),
                    lambda firsts: F.flatten(F.transform(parts, lambda p, i: _running(p, firsts[i]))))
    return let(blocks, joined)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array<struct<start int, value string>>, in code points.

    The mark cannot occur in the text (a stand-in that no pattern matches takes its place).
    """
    marked = F.regexp_replace(F.translate(text, _MARK, _STAND_IN), pattern, f"{_MARK}$0{_MARK}")

    def found(parts: Column) -> Column:
        return let(_places(F.transform(parts, F.char_length)), lambda at: F.filter(
            F.transform(parts, lambda p, i: F.struct(at[i].alias("start"), p.alias("value"))), lambda m, i: i % 2 == 1))
    return let(F.split(marked, _MARK), found)


def _looks_live(value: Column) -> Column:
    return (value.rlike("[A-Za-z]") & value.rlike("[0-9]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARS))


def _spans(found: Column, kind: int, value: Callable[[Column], Column] = lambda m: m["value"]) -> Column:
    """struct(start, end, kind, value_start, hash, looks_live) of each match."""
    def span(m: Column) -> Column:
        secret, end = value(m), m["start"] + F.char_length(m["value"])
        return F.struct(m["start"].alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
                        (end - F.char_length(secret)).alias("value_start"),
                        F.sha2(secret, 256).alias("hash"), _looks_live(secret).alias("looks_live"))
    return F.transform(found, span)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds; matches that are too short are dropped after the scan."""
    def secret(m: Column) -> Column:
        return F.regexp_extract(m["value"], ASSIGN, 2)
    assign = F.filter(matches(text, ASSIGN), lambda m: F.char_length(secret(m)) >= ASSIGN_VALUE_LEAST)
    access = F.filter(matches(text, ACCESS), lambda m: F.char_length(m["value"]) >= ACCESS_LEAST)
    # a run of hex digits that is too short hides no longer one, so only long runs are marked
    hexes = matches(text, HEX.removesuffix("+") + "{%d,}" % HEX_LEAST)
    return F.concat(_spans(assign, 0, secret), _spans(access, 1), _spans(hexes, 2))


def candidate_spans(text: Column) -> Column:
    """Other long tokens that look like credentials, as spans of the kind ``live``."""
    return F.filter(_spans(matches(text, TOKEN), LIVE), lambda s: s["looks_live"])


def ownership(occurrences: DataFrame) -> DataFrame:
    """hash, owners, repositories, occurrences of (hash, owner, repository) rows.

    A repository is known by its name within its owner; a null owner or repository is one of its own.
    """
    held = occurrences.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owned = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return owned.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"),
                                     F.sum("n").alias("occurrences"))


def _verdict() -> Column:
    return (F.when((F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES), "example")
            .when((F.col("owners") == 1) & F.col("looks_live"), "live").otherwise("shared"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id and findings, an array of
    struct(start, kind, end, value_start, hash, owners, repositories, verdict), in that order.

    Kinds assign, access and hex are the base spans; a finding of kind ``live`` is the place of a
    value (of a base span or another long token) that one owner alone holds and that looks like a
    credential.  verdict: ``example`` (held by EXAMPLE_OWNERS owners or EXAMPLE_REPOSITORIES
    repositories and more), ``live`` (one owner, live-looking) or ``shared``.

    A null text is empty and has no findings; so has an empty one.  A null owner counts as one
    owner, a null repository as one repository.  Repeated rows and repeated ids give a row each.
    An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(F.col("doc_id"), F.col(owner).alias("owner"), F.col(repository).alias("repository"),
                         F.xxhash64("doc_id", "text").alias("key"), text.alias("text"))
    rows = stored(source.select("doc_id", "owner", "repository", "key",
                                F.concat(base_spans(F.col("text")), candidate_spans(F.col("text"))).alias("spans")),
                  "secret-rows")
    occurrences = rows.select("doc_id", "key", "owner", "repository", F.explode("spans").alias("span")).select(
        "doc_id", "key", "owner", "repository", "span.*")
    counts = stored(ownership(occurrences), "secret-owners")
    total = counts.agg(F.sum("occurrences")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("occurrences") * HOT_PARTS >= total))
    cold = counts.where(F.col("occurrences") * HOT_PARTS < total)
    judged = occurrences.join(hot, "hash").unionByName(
        occurrences.join(hot.select("hash"), "hash", "left_anti").join(cold, "hash"))
    judged = judged.withColumn("verdict", _verdict())

    def finding(kind, start: str, one: str) -> Column:
        return F.struct(F.col(start).alias("start"), kind.alias("kind"), F.col("end"), F.col("value_start"), F.col("hash"),
                        F.col("owners"), F.col("repositories"), F.col("verdict")).alias(one)
    # a live value adds its own place; a candidate that is not live adds nothing
    added = F.when(F.col("verdict") == "live", F.array(finding(F.lit(LIVE), "value_start", "f")))
    kept = F.when(F.col("kind") != LIVE, F.array(finding(F.col("kind"), "start", "f")))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value_start:int,hash:string,owners:bigint,"
                             "repositories:bigint,verdict:string>>")
    findings = (judged.select("doc_id", "key", F.explode(F.concat(F.coalesce(kept, nothing), F.coalesce(added, nothing)))
                              .alias("finding"))
                .groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("finding")).alias("findings")))
    found = stored(findings, "secret-findings").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "findings")
    # only rows with spans have findings to fetch
    some = rows.where(F.size("spans") > 0).join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    none = rows.where(F.size("spans") == 0).select("doc_id", nothing.alias("findings"))
    out = some.select("doc_id", F.coalesce("findings", nothing).alias("findings")).unionByName(none)
    return out.select("doc_id", F.transform("findings", lambda f: f.withField("kind", kind_name(f["kind"]))).alias("findings"))


def kind_name(number: Column) -> Column:
    named = F.lit(None).cast("string")
    for i in reversed(range(len(KINDS))):
        named = F.when(number == i, KINDS[i]).otherwise(named)
    return named


def spans_text(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")

"""Document fingerprints: a quartile bucket digest.

Every three bytes in a row of a text's UTF-8 form are hashed into one of BUCKETS buckets.
The digest writes each bucket's quartile among the bucket counts in two bits, the length on a
logarithmic scale, the ratios of the quartiles and a checksum, as hex.  Two digests are
compared by a difference score, a sum of bucket, length, ratio and checksum differences, each
bounded, so their likeness lies between 0 and 1.  Near copies differ in few bucket quartiles.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsmith.llm.common import small_arrow_batches, stored
from logsmith.llm.words import ngram_slots

BUCKETS = 256
BUCKET_BITS = 8
#: A bucket two or three quartiles away counts more than its distance.
QUARTILE_COST = np.array([0, 1, 3, 6])
LENGTH_MOST, RATIO_MOST, CHECK_COST = 24, 15, 1
#: Differences from here on are a likeness of 0; unrelated counts differ by about this much.
FULL_DIFFERENCE = 480
CHUNK_BYTES = 1 << 22


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """Counts (a row per text) of the hashed byte triplets of whole texts."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.int64)
    group: list[int] = []
    size = 0

    def tally():
        data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in group])
        if len(data) >= 3:
            row = np.repeat(np.arange(len(group)), [len(texts[i]) for i in group])[: len(data) - 2]
            inside = np.arange(len(data) - 2) + 3 <= ends[row]
            cell = row * BUCKETS + ngram_slots(data, 3, BUCKET_BITS).astype(np.int64)
            out[group] = np.bincount(cell[inside], minlength=len(group) * BUCKETS).reshape(-1, BUCKETS)

    for i, text in enumerate(texts):
        if len(text) > CHUNK_BYTES:  # one long text alone, in chunks that overlap by two bytes
            for at in range(0, len(text), CHUNK_BYTES):
                data = np.frombuffer(text[at:at + CHUNK_BYTES + 2], np.uint8)
                if len(data) >= 3:
                    out[i] += np.bincount(ngram_slots(data, 3, BUCKET_BITS).astype(np.int64), minlength=BUCKETS)
            continue
        group.append(i)
        size += len(text)
        if size > CHUNK_BYTES:
            tally()
            group, size = [], 0
    if group:
        tally()
    return out


def digests(texts: list[bytes]) -> np.ndarray:
    """The digest bytes of each text: check, length, two ratios, then BUCKETS / 4 bytes of quartiles."""
    counts = bucket_counts(texts)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    quartile = ((counts > q1[:, None]).astype(np.uint8) + (counts > q2[:, None]) + (counts > q3[:, None])).astype(np.uint8)
    body = (quartile[:, 0::4] << 6) | (quartile[:, 1::4] << 4) | (quartile[:, 2::4] << 2) | quartile[:, 3::4]
    sizes = np.array([len(t) for t in texts], dtype=np.float64)
    head = np.empty((len(texts), 4), dtype=np.uint8)
    head[:, 0] = [zlib.crc32(t) & 0xFF for t in texts]
    head[:, 1] = np.minimum(255, np.round(8 * np.log2(sizes + 1))).astype(np.uint8)
    top = np.maximum(q3, 1)
    head[:, 2] = np.minimum(RATIO_MOST, q1 * 16 // top)
    head[:, 3] = np.minimum(RATIO_MOST, q2 * 16 // top)
    return np.concatenate([head, body], axis=1)


_UNPACK = np.stack([(np.arange(256) >> s) & 3 for s in (6, 4, 2, 0)], axis=1).astype(np.int8)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Difference scores of digests, row by row; 0 for equal digests."""
    head = np.abs(a[:, :4].astype(np.int64) - b[:, :4])
    quartiles = QUARTILE_COST[np.abs(_UNPACK[a[:, 4:]] - _UNPACK[b[:, 4:]])].sum(axis=(1, 2))
    return (quartiles + np.minimum(head[:, 1], LENGTH_MOST) + head[:, 2] + head[:, 3]
            + (head[:, 0] > 0) * CHECK_COST)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - np.minimum(difference(a, b), FULL_DIFFERENCE) / FULL_DIFFERENCE


def fingerprint_texts(texts: list[str | None]) -> list[str]:
    """Hex digests; a null text counts as empty.  Equal texts have equal digests."""
    return [bytes(x).hex() for x in digests([(t or "").encode("utf-8", "surrogatepass") for t in texts])]


def fingerprint_likeness(a: str, b: str) -> float:
    rows = [np.frombuffer(bytes.fromhex(x), np.uint8)[None, :] for x in (a, b)]
    return float(likeness(*rows)[0])


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_SCHEMA = "part long, edge string, text string, " + _RESULT


_TYPES = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
          "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
_EDGE_TYPES = {"part": pa.int64(), "edge": pa.string(), "text": pa.string()}


def _compare(ids: list, texts: list[str], nexts: list[str]) -> dict:
    changed = [edited(a, b) for a, b in zip(texts, nexts)]
    own, other, following = (digests([t.encode("utf-8", "surrogatepass") for t in x]) for x in (texts, changed, nexts))
    return {"doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [bytes(x).hex() for x in own], "edited_fingerprint": [bytes(x).hex() for x in other],
            "near_edited": likeness(own, other), "near_next": likeness(own, following)}


def _batch(columns: dict, n: int, types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()],
                                      names=list(types))


def _neighbours(batches):
    """Sorted rows (part, doc_id, text): each with the next one of its part; the first and the
    last row of a part come back as edges, with their texts."""
    types = _EDGE_TYPES | _TYPES
    part, carried = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0)[0].as_py()
        ids, texts = batch.column(1).to_pylist(), [t or "" for t in batch.column(2).to_pylist()]
        if carried is None:
            yield _batch({"part": [part], "edge": ["first"], "text": [texts[0]], "doc_id": [ids[0]]}, 1, types)
        else:
            ids, texts = [carried[0], *ids], [carried[1], *texts]
        if len(ids) > 1:
            n = len(ids) - 1
            yield _batch({"part": [part] * n, "edge": [""] * n} | _compare(ids[:-1], texts[:-1], texts[1:]), n, types)
        carried = ids[-1], texts[-1]
    if carried is not None:
        yield _batch({"part": [part], "edge": ["last"], "text": [carried[1]], "doc_id": [carried[0]]}, 1, types)


def _close_gaps(batches):
    for batch in batches:
        rows = _compare(*(c.to_pylist() for c in batch.columns))
        yield _batch(rows, batch.num_rows, _TYPES)


def fingerprints_with_next(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next; the next document is the one of the next smaller doc_id, and the
    first follows the last.

    Rows are range-partitioned by falling doc_id, so a row meets its successor in its own
    part; only the first and last row of each part (two per part) travel again.  Repeated ids
    are ordered by a hash of the text; null ids come last.  A null text counts as empty.  A
    single row follows itself.  An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text"))
    rows = stored(ranged.mapInArrow(_neighbours, _SCHEMA), "fingerprint-rows")
    edges = rows.where("edge != ''")
    # two rows per part: each last row's successor is the next part's first row, cyclically
    around = Window.orderBy("part")
    firsts = edges.where("edge = 'first'").select("part", F.col("text").alias("head"))
    chain = firsts.select("part", F.lead("part").over(around).alias("next_part"))
    lowest = firsts.agg(F.min("part").alias("lowest"))
    gaps = (edges.where("edge = 'last'").select("part", "doc_id", "text").join(chain, "part").crossJoin(F.broadcast(lowest))
            .withColumn("next_part", F.coalesce("next_part", "lowest"))
            .join(firsts.select(F.col("part").alias("next_part"), F.col("head").alias("following")), "next_part"))
    closed = gaps.select("doc_id", "text", "following").mapInArrow(_close_gaps, _RESULT)
    return rows.where("edge = ''").select(closed.columns).unionByName(closed)

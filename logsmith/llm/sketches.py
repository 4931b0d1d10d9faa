"""Fixed-size sketches of 64-bit keys, merged in two steps and small enough to broadcast.

Neither decides a result: the repeat filter lets every repeated key pass (and some others),
and frequency levels only order keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the repeat filter: about two for each key expected, up to 2**28, 32 MB as bits.  Far
#: beyond that many keys it lets most keys pass, which costs time and changes no result.
FILTER_BITS_LEAST, FILTER_BITS_MOST = 20, 28
#: Counters of the frequency sketch; as byte levels 4 MB when broadcast.
LEVEL_BITS = 22
PARTS = 64
#: Tasks whose sketches are merged first.
FAN_IN = 64
#: Keys that a task gathers before it merges them.
BUFFERED = 500_000


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unpacked(data: bytes, n: int, dtype) -> np.ndarray:
    if not n:
        return np.empty(0, dtype)
    return np.frombuffer(pa.decompress(data, n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


_SCHEMA = "part int, team int, n int, slots binary, counts binary"


def _rows(slots: np.ndarray, counts: np.ndarray, width: int) -> pa.RecordBatch:
    """One row per part: sorted slots as gaps, and their counts."""
    team = TaskContext.get().partitionId() // FAN_IN if TaskContext.get() else 0
    out = {"part": [], "team": [], "n": [], "slots": [], "counts": []}
    cuts = np.searchsorted(slots, (np.arange(PARTS + 1, dtype=np.int64) * width).clip(max=2 ** 31 - 1).astype(np.int32))
    for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            gaps = np.diff(slots[a:b] - part * width, prepend=0).astype(np.int32)
            for name, value in zip(out, (part, team, int(b - a), _packed(gaps), _packed(counts[a:b].astype(np.uint32)))):
                out[name].append(value)
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def _tally(extract, bits: int, most: int):
    """mapInArrow function: counts of the slots (top bits) of the keys that ``extract`` finds in a batch."""
    def merged(held, fresh):
        slots, counts = np.unique(np.concatenate(fresh), return_counts=True)
        both = np.concatenate([held[0], slots])
        weights = np.concatenate([held[1], np.minimum(counts, most).astype(np.int64)])
        order = np.argsort(both, kind="stable")
        both, weights = both[order], weights[order]
        starts = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        return both[starts], np.minimum(np.add.reduceat(weights, starts), most)

    def run(batches):
        held, fresh, waiting = (np.empty(0, np.int32), np.empty(0, np.int64)), [], 0
        for batch in batches:
            fresh.append((extract(batch) >> np.uint64(64 - bits)).astype(np.int32))
            waiting += len(fresh[-1])
            if waiting > BUFFERED:
                held, fresh, waiting = merged(held, fresh), [], 0
        if waiting:
            held = merged(held, fresh)
        yield _rows(*held, (1 << bits) // PARTS)
    return run


def _merge(bits: int, most: int, finish):
    """applyInPandas function: the sum of the sketches of a group, ``finish``ed as a row."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << bits) // PARTS, dtype=np.uint8 if most < 128 else np.int64)
        for n, slots, counts in zip(pdf["n"], pdf["slots"], pdf["counts"]):
            at = np.cumsum(_unpacked(slots, n, np.int32), dtype=np.int32)
            total[at] = np.minimum(total[at] + _unpacked(counts, n, np.uint32), most)
        return finish(int(pdf["part"].iloc[0]), total)
    return run


def _as_row(part: int, total: np.ndarray) -> pd.DataFrame:
    at = np.flatnonzero(total)
    return pd.DataFrame({"part": [part], "team": [0], "n": [len(at)],
                         "slots": [_packed(np.diff(at, prepend=0).astype(np.int32))],
                         "counts": [_packed(total[at].astype(np.uint32))]})


def _sketch(df: DataFrame, extract, bits: int, most: int, finish) -> dict[int, bytes]:
    """Values of the PARTS parts (absent if empty): a fixed number of bytes in all."""
    first = df.mapInArrow(_tally(extract, bits, most), _SCHEMA)
    teams = first.groupBy("part", "team").applyInPandas(_merge(bits, most, _as_row), _SCHEMA)
    rows = teams.groupBy("part").applyInPandas(_merge(bits, most, finish), "part int, value binary").collect()
    return {r["part"]: bytes(r["value"]) for r in rows}


def repeat_filter(df: DataFrame, extract, expected: int) -> np.ndarray:
    """A bit per slot: set where keys (uint64 arrays from ``extract(batch)``) fall at least twice.

    ``expected`` is about how many keys there are.
    """
    bits = min(max(int(expected).bit_length() + 1, FILTER_BITS_LEAST), FILTER_BITS_MOST)
    parts = _sketch(df, extract, bits, 2, lambda part, total: pd.DataFrame(
        {"part": [part], "value": [np.packbits(total >= 2).tobytes()]}))
    width = (1 << bits) // PARTS // 8
    out = np.zeros(PARTS * width, dtype=np.uint8)
    for part, value in parts.items():
        out[part * width:(part + 1) * width] = np.frombuffer(value, np.uint8)
    return out


def may_repeat(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may occur twice: never false for one that does."""
    slots = (keys >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


def holding(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The ``rows`` whose long ``key`` (a hash) may be in the one column of ``keys``; loses none.

    Filters before a shuffle by a bitmap of about 16 slots per key, at most 32 MB; a join has
    to follow.
    """
    bits = min(max(keys.count().bit_length() + 4, FILTER_BITS_LEAST), FILTER_BITS_MOST)
    parts = _sketch(keys, lambda batch: batch.column(0).to_numpy().view(np.uint64), bits, 1, lambda part, total: pd.DataFrame(
        {"part": [part], "value": [np.packbits(total >= 1).tobytes()]}))
    width = (1 << bits) // PARTS // 8
    held = np.zeros(PARTS * width, dtype=np.uint8)
    for part, value in parts.items():
        held[part * width:(part + 1) * width] = np.frombuffer(value, np.uint8)
    shared, at = rows.sparkSession.sparkContext.broadcast(held), rows.columns.index(key)

    def keep(batches):
        for batch in batches:
            found = may_repeat(shared.value, batch.column(at).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(found))

    return rows.mapInArrow(keep, rows.schema)


def _levels(part: int, total: np.ndarray) -> pd.DataFrame:
    levels = np.zeros(len(total), dtype=np.uint8)
    some = total > 0
    levels[some] = 1 + np.floor(4 * np.log2(total[some])).astype(np.uint8)
    return pd.DataFrame({"part": [part], "value": [levels.tobytes()]})


def frequency_levels(df: DataFrame, extract) -> np.ndarray:
    """1 + floor(4 * log2(count)) of the keys in each slot of the top LEVEL_BITS bits, 0 if none."""
    parts = _sketch(df, extract, LEVEL_BITS, 2 ** 32 - 1, _levels)
    width = (1 << LEVEL_BITS) // PARTS
    levels = np.zeros(1 << LEVEL_BITS, dtype=np.uint8)
    for part, value in parts.items():
        levels[part * width:(part + 1) * width] = np.frombuffer(value, np.uint8)
    return levels

"""Small shared building blocks: scalar joins, thresholds, output shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_row_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint for a global aggregate (no grouping keys: exactly one row).

    Only used on ``df.agg(...)`` results, whose size is bounded by construction.
    """
    return F.broadcast(df)


def percentile_threshold(df: DataFrame, column: str, p: float, exact: bool = True) -> DataFrame:
    """One-row DataFrame ``threshold`` = p-th percentile of ``column``.

    ``exact`` uses ``percentile_disc``, whose aggregation buffer is a map from
    distinct value to frequency (merged partially on the map side), so memory
    grows with the number of distinct values, not with rows.  That is the right
    tool for counts and cluster scores; ``exact=False`` uses a KLL sketch (rank
    error RANK_ERROR, fixed size, mergeable) for columns with many distinct values.
    """
    if exact:
        return df.agg(F.expr(f"percentile_disc({float(p)}) WITHIN GROUP (ORDER BY `{column}`)")
                      .cast("double").alias("threshold"))
    return df.agg(rank_sketch(column).alias("sketch")).select(quantile_of_sketch(F.col("sketch"), p).alias("threshold"))


#: Size parameter of rank sketches, and the rank error that they keep (with far more than 99 %
#: of certainty: at this size the error is about 0.4 % with 99 %).
RANK_SKETCH_K = 800
RANK_ERROR = 0.01


def rank_sketch(column: str) -> Column:
    """Aggregate: a mergeable KLL sketch of the ranks of a numeric column (NULLs are left out)."""
    return F.kll_sketch_agg_double(F.col(column).cast("double"), RANK_SKETCH_K)


def quantile_of_sketch(sketch: Column, p: float) -> Column:
    """The p-th quantile, NULL for a sketch of no values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (sums of doubles depend on evaluation order)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def ntz_timestamps(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall-clock ``timestamp_ntz`` at the output boundary."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def total_bytes(column: str | Column) -> Column:
    """Sum of byte counts as bigint, NULL when the true sum does not fit (never an overflow error).

    Summed as decimal, so that one absurd size in one line cannot stop a job or a stream.
    """
    col = F.col(column) if isinstance(column, str) else column
    return F.sum(col.cast("decimal(38,0)")).try_cast("bigint")


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 or NULL (never throws under ANSI)."""
    return F.try_divide(num.cast("double"), den.cast("double"))

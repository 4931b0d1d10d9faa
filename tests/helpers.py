"""Shared test helpers (imported by name; a conftest is never imported)."""

SF_SMALL = "/root/testdata/sf0.001"


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")

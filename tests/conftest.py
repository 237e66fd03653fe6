import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinelake.session import build_session, remove_scratch
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    remove_scratch(s)
    s.stop()


def bronze_df(spark, rows, key="movie_id"):
    """Hand-written bronze rows: (key, endpoint, json text, ingested_at text)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, f"{key} bigint, endpoint string, raw string, ingested_at string")
    return df.select(key, "endpoint", F.parse_json("raw").alias("raw_json"),
                     F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


def rows_of(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

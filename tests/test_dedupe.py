from pyspark.sql import functions as F

from cinelake.operators.dedupe import latest_key_list, latest_per_key
from tests.conftest import rows_of


def test_newest_wins_and_ties_are_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, "2024-01-01"), (1, "b", 2, "2024-01-02"), (1, "c", 3, "2024-01-02"),
         (2, None, 1, "2024-01-01"), (2, "z", 1, "2024-01-01")],
        "k int, name string, n int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = rows_of(latest_per_key(df, ["k"], newest="ts"), "k", "name", "n")
    # key 1: two rows at the newest time -> greatest payload tuple ("c"); key 2: NULL is lowest
    assert got == [(1, "c", 3), (2, "z", 1)]


def test_first_position_breaks_ties_before_payload(spark):
    df = spark.createDataFrame([(1, 10, "B", 0), (1, 10, "A", 1), (1, 11, "X", 0)],
                               "m int, p int, ch string, pos int").withColumn("ts", F.lit("2024-01-01").cast("date"))
    got = rows_of(latest_per_key(df, ["m", "p"], newest="ts", first=["pos"], drop=["pos", "ts"]))
    assert got == [(1, 10, "B"), (1, 11, "X")]


def test_latest_key_list_is_distinct(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows_of(latest_key_list(df, "id")) == [(1,), (2,)]


def test_hot_key_uses_partial_aggregation(spark):
    # one key with most rows: the plan must pre-aggregate before the shuffle
    df = spark.range(0, 20000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id",
                                      F.lit("2024-01-01").cast("date").alias("ts"))
    out = latest_per_key(df, ["k"], newest="ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert rows_of(out, "k", "id") == [(0, 19999), (1, 19998)]

import pytest
from pyspark.sql import functions as F

from cinelake.functions import jsonops as J


def _v(spark, text):
    return spark.createDataFrame([(text,)], "s string").select(F.parse_json("s").alias("v"))


def test_missing_and_null_paths_give_null(spark):
    r = _v(spark, '{"a": null, "b": "x"}').select(
        J.json_string("v", "a").alias("a"), J.json_string("v", "zz").alias("zz"), J.json_string("v", "b").alias("b"),
        J.json_bigint("v", "zz").alias("n")).first()
    assert (r.a, r.zz, r.b, r.n) == (None, None, "x", None)


def test_integer_cast_rounds_half_up_and_keeps_big_values(spark):
    r = _v(spark, '{"a": 2.5, "b": 2.4, "c": 3000000000, "d": -2.5}').select(
        *[J.json_bigint("v", k).alias(k) for k in "abcd"]).first()
    assert (r.a, r.b, r.c, r.d) == (3, 2, 3000000000, -3)


def test_blank_and_missing_dates_are_null(spark):
    df = spark.createDataFrame([('{"d": ""}',), ('{}',), ('{"d": null}',), ('{"d": "2024-02-29"}',)], "s string")
    got = [r.d for r in df.select(J.json_date(F.parse_json("s"), "d").alias("d")).collect()]
    assert [str(x) if x else None for x in got] == [None, None, None, "2024-02-29"]


def test_blank_to_null_only_blank(spark):
    r = _v(spark, '{"a": "", "b": " "}').select(J.blank_to_null(J.json_string("v", "a")).alias("a"),
                                              J.blank_to_null(J.json_string("v", "b")).alias("b")).first()
    assert (r.a, r.b) == (None, " ")


@pytest.mark.parametrize("doc", ['{"g": []}', '{"g": null}', '{}', '{"g": 5}'])
def test_flatten_gives_no_rows_for_empty_null_missing_scalar(spark, doc):
    assert _v(spark, doc).select(F.explode(J.json_array("v", "g"))).count() == 0


def test_flatten_keeps_positions(spark):
    got = _v(spark, '{"g": [{"id": 7}, {"id": 8}]}').select(F.posexplode(J.json_array("v", "g"))).select(
        "pos", J.json_bigint("col", "id").alias("id")).collect()
    assert [(r.pos, r.id) for r in got] == [(0, 7), (1, 8)]


def test_wrong_type_fails_loudly(spark):
    with pytest.raises(Exception):
        _v(spark, '{"a": "abc"}').select(J.json_bigint("v", "a")).collect()


def test_malformed_json_fails_strict_parse_and_is_counted(spark):
    from cinelake.sources import bronze
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',)], "s string")
    with pytest.raises(Exception):
        bronze.parse_json_ingest(df, "s").collect()
    assert bronze.count_malformed(df, "s").first().malformed_rows == 1

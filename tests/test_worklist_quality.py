import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cinelake.operators import quality, worklist
from cinelake.sources import bronze
from cinelake.sources.landing import envelope
from tests.conftest import bronze_df, rows_of


def test_details_worklist_any_snapshot_and_nulls(spark):
    raw = bronze_df(spark, [(1, "d", '{"id":1,"popularity":0.5}', "2024-01-01"),
                            (1, "d", '{"id":1,"popularity":1.0}', "2024-01-02"),
                            (2, "d", '{"id":2}', "2024-01-01"),
                            (3, "d", '{"id":3,"popularity":5}', "2024-01-01"),
                            (4, "d", '{"id":4,"popularity":9}', "2024-01-01")])
    details = bronze_df(spark, [(4, "/movie/4", '{"id":4}', "2024-01-03")])
    assert rows_of(worklist.details_worklist(raw, details)) == [(1,), (3,)]
    assert rows_of(worklist.details_worklist(raw, details, threshold=9)) == []
    assert rows_of(worklist.credits_worklist(details, bronze_df(spark, []))) == [(4,)]


def test_high_water_marks_and_defaults(spark):
    empty = spark.createDataFrame([], "ts timestamp_ntz, s string")
    assert worklist.high_water_date(empty, "ts").first().high_water == "2023-06-25"
    assert worklist.high_water_timestamp(empty, "ts").first().high_water == "2023-01-01T00:00:00Z"
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 10, 30), "2024-01-15T10:30:00Z")], "ts timestamp_ntz, s string")
    assert worklist.high_water_timestamp(df, "ts").first().high_water == "2024-01-15T10:25:00Z"
    assert worklist.high_water_timestamp(df, "s").first().high_water == "2024-01-15T10:25:00Z"
    assert worklist.high_water_date(df, "ts").first().high_water == "2024-01-15"


def test_parse_utc_timestamp_formats(spark):
    df = spark.createDataFrame([("2024-01-15T10:30:00Z",), ("2024-01-15T10:30:00.123Z",),
                                ("2024-01-15T12:30:00+02:00",), ("",), (None,)], "s string")
    got = [r.t for r in df.select(worklist.parse_utc_timestamp("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 15, 10, 30) and got[2] == dt.datetime(2024, 1, 15, 10, 30)
    assert got[1] == dt.datetime(2024, 1, 15, 10, 30, 0, 123000) and got[3] is None and got[4] is None


def test_month_windows_from_2026_02(spark):
    anchor = spark.createDataFrame([(dt.date(2026, 2, 10),)], "d date")
    w = worklist.month_windows(anchor, "d")
    assert w.count() == 1826
    first = w.orderBy(F.col("month_start").desc()).first()
    assert (str(first.month_start), str(first.month_end)) == ("2026-02-01", "2026-02-28")


def test_backfill_windows_at_most_14_days(spark):
    b = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 30))], "s date, e date")
    got = [(str(r.window_start), str(r.window_end)) for r in worklist.backfill_windows(b, "s", "e").collect()]
    assert got == [("2024-01-01", "2024-01-14"), ("2024-01-15", "2024-01-28"), ("2024-01-29", "2024-01-30")]


def _pages(spark, pages, run="r1"):
    rows = [(json.dumps({"page": p, "results": [{"id": i} for i in range(n)], "total_pages": tp}),) for p, n, tp in pages]
    df = spark.createDataFrame(rows, "b string")
    return df.select(*envelope(F.lit("/discover/movie"), F.lit(200), F.lit("2024-02-01").cast("timestamp_ntz"),
                               F.parse_json("b"), None, F.lit("2024-01-01").cast("date"), F.lit(run)))


def test_no_page_cap_and_no_mixing_of_runs(spark):
    many = _pages(spark, [(p, 1, 600) for p in range(1, 601)])
    assert worklist.accept_pages(many).count() == 600
    assert worklist.accept_pages(many, max_pages=500).count() == 500
    assert worklist.truncated_months(many).first().truncated
    two = _pages(spark, [(1, 20, 2), (2, 5, 2)], "early").unionByName(_pages(spark, [(p, 20, 5) for p in range(1, 6)], "late"))
    assert rows_of(worklist.accept_pages(two), "run_id", "page") == [("early", 1), ("early", 2)] + [("late", p) for p in range(1, 6)]


def _status(spark, status, body):
    df = spark.createDataFrame([(status, body)], "st int, b string")
    return df.select(*envelope(F.lit("/discover/movie"), F.col("st"), F.lit("2024-02-01").cast("timestamp_ntz"), F.parse_json("b"), F.lit(1),
                               F.lit("2024-01-01").cast("date"), F.lit("r1")))


@pytest.mark.parametrize("status", [500, 429, 404, None])
def test_a_failing_page_stops_acceptance(spark, status):
    pages = _pages(spark, [(1, 20, 3), (3, 20, 3)]).unionByName(_status(spark, status, '{"status_code": 11}'))
    with pytest.raises(Exception, match="unexpected HTTP status"):
        worklist.accept_pages(pages).collect()
    for land in (bronze.land_movie_rows, bronze.land_genre_rows, bronze.change_list_rows):
        with pytest.raises(Exception, match="unexpected HTTP status"):
            land(_status(spark, status, '{"status_code": 11}')).collect()


def test_a_page_without_number_stops_acceptance(spark):
    with pytest.raises(Exception, match="no page number"):
        worklist.accept_pages(_status(spark, 200, '{"results": []}')).collect()


def test_details_and_credits_skip_404_and_429_only(spark):
    for land in (bronze.land_detail_rows, bronze.land_credit_rows):
        assert land(_status(spark, 404, "{}")).count() == 0 and land(_status(spark, 429, "{}")).count() == 0
        assert land(_status(spark, 200, "{}")).count() == 1
        for status in (500, None):
            with pytest.raises(Exception, match="unexpected HTTP status"):
                land(_status(spark, status, "{}")).collect()


@pytest.mark.parametrize("value", ['{"id": 1}', '"x"', "3"])
def test_something_else_than_an_array_stops_the_job(spark, value):
    with pytest.raises(Exception, match="not an array"):
        bronze.land_movie_rows(_status(spark, 200, '{"page": 1, "results": %s}' % value)).collect()
    with pytest.raises(Exception, match="not an array"):
        bronze.land_genre_rows(_status(spark, 200, '{"genres": %s}' % value)).collect()
    assert bronze.land_movie_rows(_status(spark, 200, '{"page": 1, "results": null}')).count() == 0


def test_newest_export_comes_from_names(spark, tmp_path):
    for day, ids in (("12_31_2025", (1, 2)), ("01_02_2026", (3,))):
        spark.createDataFrame([('{"id": %d}' % i,) for i in ids], "value string").coalesce(1).write.option(
            "compression", "gzip").text(f"{tmp_path}/movie_ids_{day}.json.gz")
    newest = bronze.newest_export(spark, f"{tmp_path}/movie_ids_*")
    assert len(newest) == 1 and newest[0].endswith("movie_ids_01_02_2026.json.gz")
    assert rows_of(bronze.read_id_export(spark, newest), "movie_id") == [(3,)]


def test_accept_pages_stops_at_first_empty_page(spark):
    got = rows_of(worklist.accept_pages(_pages(spark, [(1, 20, 3), (2, 0, 3), (3, 20, 3)])), "page")
    assert got == [(1,)]
    got = rows_of(worklist.accept_pages(_pages(spark, [(1, 20, 2), (2, 5, 2), (3, 20, 2)])), "page")
    assert got == [(1,), (2,)]                      # page >= total_pages ends the loop (included)
    got = rows_of(worklist.accept_pages(_pages(spark, [(1, 20, 5), (3, 20, 5), (4, 20, 5)])), "page")
    assert got == [(1,)]                            # page 2 never landed: 3 and 4 were unreachable
    assert rows_of(worklist.accept_pages(_pages(spark, [(2, 20, 5), (3, 20, 5)])), "page") == []
    rows = bronze.land_movie_rows(worklist.accept_pages(_pages(spark, [(1, 3, 1)])).drop("month"))
    assert rows.count() == 3


def test_unexpected_status_stops_the_job(spark):
    df = spark.createDataFrame([(500, '{"id": 1}')], "st int, b string").select(
        *envelope(F.lit("/movie/1"), F.col("st"), F.lit("2024-01-01").cast("timestamp_ntz"), F.parse_json("b"),
                  F.lit(1)))
    import pytest
    with pytest.raises(Exception):
        bronze.land_detail_rows(df).collect()


def test_quality_null_and_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (5, 2), (5, 3), (6, 4)], "k int, v int")
    nn = quality.test_not_null(df, ["k", "v"], "t").collect()
    assert {r.column_names: r.failures for r in nn} == {"k": 1, "v": 0}
    assert quality.test_unique(df, "k", "t").first().failures == 1
    assert quality.test_unique_combination(df, ["k"], "t").first().failures == 1
    assert len(quality.DECLARED_TESTS) == 13
    n = sum(len(t.get("not_null", [])) + len(t.get("unique", [])) + len(t.get("combination", []))
            for t in quality.DECLARED_TESTS.values())
    assert n == 67

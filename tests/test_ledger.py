"""The load ledger of (run, month) pairs, the refresh of changed movies, and the bucketed layout."""

import json

import pytest
from pyspark.sql import functions as F

from cinelake.operators import quality, worklist
from cinelake.plans import catalog, gold, jobs, silver
from cinelake.session import scratch_dir
from cinelake.sources import bronze, landing
from tests.conftest import SF_SMALL, rows_of


def responses(spark, rows, endpoint="/discover/movie"):
    """(run, day or None, key or None, status, fetched_at, body) as a landing frame."""
    df = spark.createDataFrame([(*r[:5], json.dumps(r[5])) for r in rows], "run string, day string, key bigint, st int, at string, b string")
    return df.select(*landing.envelope(F.lit(endpoint), F.col("st"), F.col("at").cast("timestamp_ntz"), F.parse_json("b"),
                                       F.col("key"), F.col("day").cast("date"), F.col("run")))


def page(run, month, n, of, ids):
    return run, f"2024-{month:02d}-01", None, 200, "2024-06-01 00:00:00", {"page": n, "total_pages": of, "results": [{"id": i, "popularity": 5.0} for i in ids]}


def movies(spark, root):
    return [r[0] for r in jobs.read_bronze(spark, root).movie.select("movie_id").orderBy("movie_id").collect()]


def test_every_landed_month_arrives_by_either_job_in_any_order(spark):
    base = scratch_dir(spark, "test-ledger")
    land, root = f"{base}/landing/discover", f"{base}/catalog"
    landing.write_landing(responses(spark, [page("r1", 1, 1, 1, [11]), page("r2", 1, 1, 1, [12]), page("r2", 2, 1, 1, [21])]), land)
    jobs.load_movies(spark, land, root, "2024-02-01")
    assert movies(spark, root) == [21]                       # the other months stay open
    jobs.full_backfill(spark, land, root)
    assert movies(spark, root) == [11, 12, 21]
    assert not jobs.open_runs(spark, land, root) and jobs.load_movies(spark, land, root) is None
    landing.write_landing(responses(spark, [page("r3", 3, 1, 1, [31]), page("r3", 4, 1, 1, [41])]), land, mode="append")
    assert {r[1].month for r in jobs.load_movies(spark, land, root).collect()} == {3, 4}     # by default every month of a new run
    assert movies(spark, root) == [11, 12, 21, 31, 41]


def test_a_late_page_opens_its_month_again(spark):
    base = scratch_dir(spark, "test-late")
    land, root = f"{base}/discover", f"{base}/catalog"
    landing.write_landing(responses(spark, [page("r1", 1, 1, 3, [1]), page("r1", 1, 3, 3, [3]), page("r1", 2, 1, 1, [9])]), land)
    jobs.load_movies(spark, land, root)
    assert movies(spark, root) == [1, 9]                     # page 3 stands behind a gap
    landing.write_landing(responses(spark, [page("r1", 1, 2, 3, [2])]), land, mode="append")
    assert [(r.run_id, r.month.month, r.pages) for r in jobs.load_movies(spark, land, root).collect()] == [("r1", 1, 3)]
    assert movies(spark, root) == [1, 2, 3, 9]


def test_a_crash_before_the_ledger_loads_the_same_folders_again(spark, monkeypatch):
    base = scratch_dir(spark, "test-ledger-crash")
    land, root = f"{base}/discover", f"{base}/catalog"
    landing.write_landing(responses(spark, [page("r1", 1, 1, 1, [1, 2]), page("r1", 2, 1, 1, [3])]), land)
    load = jobs._load

    def crash(*args):
        load(*args)
        raise RuntimeError("lost")
    monkeypatch.setattr(jobs, "_load", crash)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.load_movies(spark, land, root)
    monkeypatch.setattr(jobs, "_load", load)
    jobs.full_backfill(spark, land, root)
    assert movies(spark, root) == [1, 2, 3]


def details(run, movie, at, title="t"):
    return run, None, movie, 200, at, {"id": movie, "title": title}


def test_details_that_nobody_asked_for_yet_are_taken_later(spark):
    base = scratch_dir(spark, "test-left")
    land, root = f"{base}/details", f"{base}/catalog"
    landing.write_landing(responses(spark, [details("d1", 1, "2024-01-01"), details("d1", 2, "2024-01-01")]), land)
    todo = lambda *ids: spark.createDataFrame([(i,) for i in ids], "movie_id bigint")
    jobs._append_worklist(spark, land, root, "movie_details_raw", todo(1), bronze.land_detail_rows)
    assert rows_of(jobs.read_bronze(spark, root).details, "movie_id") == [(1,)]
    jobs._append_worklist(spark, land, root, "movie_details_raw", todo(2), bronze.land_detail_rows)      # its run is opened again
    jobs._append_worklist(spark, land, root, "movie_details_raw", todo(), bronze.land_detail_rows)
    assert rows_of(jobs.read_bronze(spark, root).details, "movie_id") == [(1,), (2,)]


def change_page(run, day, n, of, ids, until=None):
    return run, day, None, 200, "2024-02-20 00:00:00", {"page": n, "total_pages": of, "results": [{"id": i, "adult": False} for i in ids]}, until


def write_changes(spark, path, rows, mode="errorifexists"):
    df = responses(spark, [r[:6] for r in rows], "/movie/changes")
    ends = spark.createDataFrame([(r[0], r[1], r[6]) for r in rows if r[6]], "run_id string, d string, until string").distinct()
    df = df.join(ends, (df.run_id == ends.run_id) & (df.request_date == F.to_date("d")), "left").select(
        df.run_id, F.when(F.col("until").isNotNull(), F.concat(F.lit("/movie/changes?start_date="), "d", F.lit("&end_date="), "until")).otherwise(
            F.col("endpoint")).alias("endpoint"), "http_status", "fetched_at", "request_key", "request_date", "body")
    landing.write_landing(df, path, mode=mode)


def test_changed_movies_are_fetched_again_and_gaps_listed(spark):
    base = scratch_dir(spark, "test-refresh")
    land, root = f"{base}/landing", f"{base}/catalog"
    landing.write_landing(responses(spark, [details("d1", i, "2024-01-10 08:00:00", "old") for i in (1, 2, 3, 4)]), f"{land}/details")
    jobs._append_worklist(spark, f"{land}/details", root, "movie_details_raw", spark.range(1, 5).withColumnRenamed("id", "movie_id"), bronze.land_detail_rows)
    write_changes(spark, f"{land}/changes", [
        change_page("c1", "2024-01-01", 1, 1, [1, 77], "2024-01-09"), change_page("c1", "2024-01-10", 1, 1, [2]),
        change_page("c1", "2024-01-11", 1, 2, [3]),                                              # its second page has not landed
        change_page("c2", "2024-01-05", 1, 1, [], "2024-01-15")])                                # overlaps; covers the 11th too
    left = {r.movie_id for r in jobs.refresh_changed(spark, land, root).collect()}
    assert left == {2, 3}                    # 1 changed before its fetch, 2 on that very day, 77 is not in the catalogue
    assert [(str(r.window_start), str(r.window_end)) for r in jobs.missing_changes(spark, root, "2023-12-30", "2024-02-05").orderBy("window_start").collect()] == [
        ("2023-12-30", "2023-12-31"), ("2024-01-16", "2024-01-29"), ("2024-01-30", "2024-02-05")]
    landing.write_landing(responses(spark, [details("d2", i, "2024-01-20 00:00:00", "new") for i in (1, 2, 4)] + [("d2", None, 3, 404, "2024-01-20 00:00:00", {})]),
                          f"{land}/details", mode="append")
    for _ in range(2):
        assert [r.movie_id for r in jobs.refresh_changed(spark, land, root).collect()] == [3]    # not found: still to be fetched
    now = jobs.read_bronze(spark, root).details
    assert rows_of(now.groupBy("movie_id").count()) == [(1, 1), (2, 2), (3, 1), (4, 1)]           # only what changed is taken again
    assert rows_of(silver.silver_movie_details(now), "movie_id", "title") == [(1, "old"), (2, "new"), (3, "old"), (4, "old")]
    # a later change makes 2 stale again, and run d2, which also had 1 and 4, is opened for 4
    write_changes(spark, f"{land}/changes", [change_page("c3", "2024-01-18", 1, 1, [2, 4])], mode="append")
    assert [r.movie_id for r in jobs.refresh_changed(spark, land, root).orderBy("movie_id").collect()] == [3]
    assert rows_of(jobs.read_bronze(spark, root).details.groupBy("movie_id").count()) == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_missing_windows_of_nothing_and_everything(spark):
    bounds = spark.sql("SELECT DATE '2024-01-01' AS first, DATE '2024-01-20' AS last")
    none = spark.createDataFrame([], "window_start date, window_end date")
    assert [(r[0].day, r[1].day) for r in worklist.missing_windows(none, bounds).orderBy("window_start").collect()] == [(1, 14), (15, 20)]
    whole = spark.sql("SELECT DATE '2023-12-01' AS window_start, DATE '2024-03-01' AS window_end")
    assert worklist.missing_windows(whole, bounds).count() == 0


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning")


def test_written_silver_meets_on_its_key_without_an_exchange(spark):
    root = scratch_dir(spark, "test-buckets")
    models = catalog.silver_models(catalog.testbed_bronze(spark, SF_SMALL))
    names = ("silver_movie", "silver_movie_details", "silver_movie_cast", "silver_bridge_movie_genre")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in names:
            jobs.materialize_table(models[n], root, "silver", n)
        s = {n: jobs.read_table(spark, root, "silver", n) for n in names}
        joined = gold.dim_movie(s["silver_movie"], s["silver_movie_details"])
        assert exchanges(joined) == 0
        assert rows_of(joined.select("movie_id", "title")) == rows_of(gold.dim_movie(models["silver_movie"], models["silver_movie_details"]).select("movie_id", "title"))
        for n in names:
            report = quality.table_tests(s[n], quality.DECLARED_TESTS[n], n)
            assert exchanges(report) == 0
            assert rows_of(report) == rows_of(quality.table_tests(models[n], quality.DECLARED_TESTS[n], n))
        # a new version is read with its own files, also by a session whose catalogue has not seen it
        jobs.materialize_table(models["silver_movie"].limit(5), root, "silver", "silver_movie", version=9_999_999_999_999)
        assert jobs.read_table(spark, root, "silver", "silver_movie").count() == 5
        for t in spark.catalog.listTables():
            if t.name.startswith("cinelake_"):
                spark.sql(f"DROP TABLE {t.name}")
        assert jobs.read_table(spark, root, "silver", "silver_movie").count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

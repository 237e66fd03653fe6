"""Registered queries beyond the model graph: landing, worklists, tests,
discovery, jobs and streams (SURVEY sections 2.1-2.7).

Every query reads the driver tables at ``sf_dir`` through the test bed.
Queries that exercise writers (append, materialise, exports, streams) write
into a fresh folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake import oracle as O
from cinelake.functions.jsonops import (flatten_match_row, flatten_scalar_array, flatten_struct_array, json_array, json_bigint,
                                        json_double, json_string)
from cinelake.operators import dedupe, quality, worklist
from cinelake.plans import catalog, discover, gold, jobs, popularity_days, search_index, silver
from cinelake.registry import register
from cinelake.session import scratch_dir
from cinelake.sources import bronze, landing, testbed
from cinelake.sources import testbed as tb
from cinelake.streaming import bronze_stream

W = O.with_ctes

# ---- fixed parameters of the registered discovery queries ---------------------------
TOP_N = 10
MIN_VOTES = 40
BROWSE = dict(genre_id=5, min_popularity=2.0, min_rating=5.0, year_from=1995, year_to=1998)
GENRE_SET = [1, 2]
TITLE_QUERY = "ring"
MULTI_QUERY = "pl"
EXPORT_DATES = ("01_14_2026", "01_15_2026")   # older export: parts with p_size <= 45; newest: all parts
OLDER_EXPORT_MAX_SIZE = 45
APPEND_SPLIT = "1998-01-01"                    # A7: first append = rows ingested before this day
# -------------------------------------------------------------------------------------


def _b(spark, sf):
    return catalog.testbed_bronze(spark, sf)


def _m(spark, sf):
    return catalog.all_models(_b(spark, sf))


# ---- 2.1 sources, landing, sinks ----------------------------------------------------
@register("land_genre_rows", W("""
    SELECT genre_id, endpoint, ingested_at, (SELECT count(*) FROM nation) AS genres_in_document
    FROM genre_rows"""))
def q_land_genre_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.land_genre_rows(testbed.genre_landing(spark, sf))
    return rows.select("genre_id", "endpoint", "ingested_at",
                       F.size(json_array("raw_json", "genres")).cast("bigint").alias("genres_in_document"))


@register("land_movie_rows", W("""
    SELECT movie_id, endpoint, page_fetched_at AS ingested_at, title, popularity, l_orderkey,
           CAST(l_linenumber AS BIGINT) AS l_linenumber
    FROM landed_movie_rows"""))
def q_land_movie_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.land_movie_rows(testbed.discover_landing(spark, sf))
    return rows.select("movie_id", "endpoint", "ingested_at", json_string("raw_json", "title").alias("title"),
                       json_double("raw_json", "popularity").alias("popularity"),
                       json_bigint("raw_json", "l_orderkey").alias("l_orderkey"),
                       json_bigint("raw_json", "l_linenumber").alias("l_linenumber"))


@register("land_detail_rows", W("SELECT movie_id, endpoint, ingested_at, title FROM details_rows"))
def q_land_detail_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.land_detail_rows(testbed.details_landing(spark, sf))
    return rows.select("movie_id", "endpoint", "ingested_at", json_string("raw_json", "title").alias("title"))


@register("land_credit_rows", W("""
    SELECT movie_id, '/movie/' || CAST(movie_id AS VARCHAR) || '/credits' AS endpoint, ingested_at,
           count(*) AS cast_size, count(*) AS crew_size
    FROM credit_rows GROUP BY movie_id, ingested_at"""))
def q_land_credit_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.land_credit_rows(testbed.credits_landing(spark, sf))
    return rows.select("movie_id", "endpoint", "ingested_at",
                       F.size(json_array("raw_json", "cast")).cast("bigint").alias("cast_size"),
                       F.size(json_array("raw_json", "crew")).cast("bigint").alias("crew_size"))


@register("parse_json_ingest", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(json_extract(props, '$.k') AS DOUBLE) AS k_double FROM events""")
def q_parse_json_ingest(spark: SparkSession, sf: str) -> DataFrame:
    ev = bronze.parse_json_ingest(tb.table(spark, sf, "events").select("event_id", "props"), "props")
    return ev.select("event_id", json_bigint("raw_json", "k").alias("k"),
                     json_double("raw_json", "k").alias("k_double"))


@register("bronze_contract", W("SELECT movie_id, endpoint, ingested_at, movie_id AS json_id FROM movie_rows"))
def q_bronze_contract(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.bronze_contract(testbed.movie_raw(spark, sf), "movie_id")
    return rows.select("movie_id", "endpoint", "ingested_at", json_bigint("raw_json", "id").alias("json_id"))


@register("bronze_append", W("SELECT movie_id, endpoint, ingested_at, l_orderkey FROM movie_rows"))
def q_bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "bronze-append")
    raw = testbed.movie_raw(spark, sf)
    split = F.lit(APPEND_SPLIT).cast("timestamp_ntz")
    bronze.bronze_append(raw.where(F.col("ingested_at") < split), path)
    bronze.bronze_append(raw.where(F.col("ingested_at") >= split), path)
    back = spark.read.parquet(path)
    return back.select("movie_id", "endpoint", "ingested_at",
                       json_bigint("raw_json", "l_orderkey").alias("l_orderkey"))


@register("drop_column_if_exists", W("SELECT movie_id, endpoint, ingested_at FROM movie_rows"))
def q_drop_column_if_exists(spark: SparkSession, sf: str) -> DataFrame:
    legacy = testbed.movie_raw(spark, sf).withColumn("movie_name", F.lit(None).cast("string"))
    once = bronze.drop_column_if_exists(legacy, "movie_name")
    twice = bronze.drop_column_if_exists(once, "movie_name")     # missing now: still no error
    return twice.drop("raw_json")


@register("bronze_scan", W(f"""
    SELECT 'genre_raw' AS table_name, count(*) AS row_count FROM genre_rows
    UNION ALL SELECT 'movie_raw', count(*) FROM movie_rows
    UNION ALL SELECT 'movie_details_raw', count(*) FROM details_rows
    UNION ALL SELECT 'movie_credits_raw', count(*) FROM
      (SELECT DISTINCT movie_id, ingested_at FROM credit_rows)"""))
def q_bronze_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "bronze-scan")
    b = _b(spark, sf)
    for name, df in zip(bronze.BRONZE_TABLES, (b.genre, b.movie, b.details, b.credits)):
        bronze.bronze_append(df, f"{root}/{name}")
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in bronze.bronze_scan(spark, root).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("materialize_table", O.model_sql("silver_movie"))
def q_materialize_table(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "catalog")
    df = silver.silver_movie(testbed.movie_raw(spark, sf))
    jobs.materialize_table(df, root, "silver", "silver_movie", version=1)
    jobs.materialize_table(df, root, "silver", "silver_movie", version=2)   # a rebuild: new version
    return jobs.read_table(spark, root, "silver", "silver_movie")


@register("layer_routing", W("SELECT movie_id, title, 'gold' AS layer FROM o_dim_movie"))
def q_layer_routing(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "catalog")
    m = _m(spark, sf)
    jobs.materialize_table(m["dim_movie"], root, "gold", "dim_movie")
    back = jobs.read_table(spark, root, "gold", "dim_movie")
    return back.select("movie_id", "title",
                       F.regexp_extract(F.col("_metadata.file_path"), r"/(bronze|silver|gold)/dim_movie/", 1)
                       .alias("layer"))


@register("ordered_scan", W("SELECT * FROM o_silver_movie ORDER BY movie_id"))
def q_ordered_scan(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.ordered_scan(silver.silver_movie(testbed.movie_raw(spark, sf)), "movie_id")


@register("count_rows", W("SELECT count(1) AS row_count FROM o_silver_movie"))
def q_count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.count_rows(silver.silver_movie(testbed.movie_raw(spark, sf)))


def _write_exports(spark: SparkSession, sf: str) -> str:
    root = scratch_dir(spark, "exports")
    lines = testbed.id_export_lines(spark, sf)
    older = tb.table(spark, sf, "part").where(F.col("p_size") <= OLDER_EXPORT_MAX_SIZE).select("p_partkey")
    older_lines = testbed.id_export_lines(spark, sf).join(
        older, F.variant_get(F.parse_json("value"), "$.id", "bigint") == F.col("p_partkey"), "left_semi")
    older_lines.write.option("compression", "gzip").text(f"{root}/movie_ids_{EXPORT_DATES[0]}.json.gz")
    lines.write.option("compression", "gzip").text(f"{root}/movie_ids_{EXPORT_DATES[1]}.json.gz")
    return root


def _export_sql(date_mmddyyyy: str, where: str) -> str:
    m, d, y = date_mmddyyyy.split("_")
    return (f"SELECT DATE '{y}-{m}-{d}' AS ingestion_date, p_partkey AS movie_id, p_size % 2 = 0 AS adult, "
            f"false AS video, p_retailprice / 100 AS popularity FROM part WHERE {where}")


@register("read_id_export", _export_sql(EXPORT_DATES[0], f"p_size <= {OLDER_EXPORT_MAX_SIZE}")
          + " UNION ALL " + _export_sql(EXPORT_DATES[1], "true"))
def q_read_id_export(spark: SparkSession, sf: str) -> DataFrame:
    root = _write_exports(spark, sf)
    return bronze.read_id_export(spark, f"{root}/movie_ids_*").drop("raw_line")


@register("change_list_rows", W("SELECT change_date, movie_id, adult, page FROM change_rows"))
def q_change_list_rows(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.change_list_rows(testbed.changes_landing(spark, sf)).drop("raw_json")


@register("drop_missing_responses", W("SELECT movie_id, 200 AS http_status, ingested_at AS fetched_at "
                                       "FROM found_details"))
def q_drop_missing_responses(spark: SparkSession, sf: str) -> DataFrame:
    ok = bronze.drop_missing_responses(testbed.details_landing(spark, sf, not_found=True), bronze.SKIPPED_STATUSES)
    return ok.select(F.col("request_key").alias("movie_id"), "http_status", "fetched_at")


# ---- 2.2 worklists and incremental reads ----------------------------------------------
@register("details_worklist", W("""
    SELECT DISTINCT movie_id FROM movie_rows
    WHERE popularity >= 1 AND movie_id NOT IN (SELECT DISTINCT movie_id FROM found_details)
    ORDER BY movie_id"""))
def q_details_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.details_worklist(testbed.movie_raw(spark, sf), _found_details(spark, sf))


def _found_details(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze details where the API did not know every part."""
    return bronze.land_detail_rows(testbed.details_landing(spark, sf, not_found=True))


@register("credits_worklist", W(f"""
    SELECT DISTINCT movie_id FROM details_rows
    WHERE movie_id NOT IN (SELECT movie_id FROM credit_rows JOIN part ON movie_id = p_partkey
                           WHERE p_size <= {tb.LAGGING_CREDITS_SIZE}) ORDER BY movie_id"""))
def q_credits_worklist(spark: SparkSession, sf: str) -> DataFrame:
    b = _b(spark, sf)
    lagging = testbed.credits_landing(spark, sf, tb.LAGGING_CREDITS_SIZE)
    return worklist.credits_worklist(b.details, bronze.land_credit_rows(lagging))


@register("high_water_date", "SELECT COALESCE(strftime(max(ts), '%Y-%m-%d'), '2023-06-25') AS high_water "
                             "FROM events")
def q_high_water_date(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.high_water_date(tb.table(spark, sf, "events"), "ts")


@register("high_water_timestamp", "SELECT COALESCE(strftime(max(ts) - INTERVAL 5 MINUTE, '%Y-%m-%dT%H:%M:%SZ'), "
                                  "'2023-01-01T00:00:00Z') AS high_water FROM events")
def q_high_water_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.high_water_timestamp(tb.table(spark, sf, "events"), "ts")


@register("latest_key_list", "SELECT DISTINCT user_id FROM events")
def q_latest_key_list(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_key_list(tb.table(spark, sf, "events"), "user_id")


@register("parse_utc_timestamp", """
    SELECT event_id,
           CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                             WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
                             WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')
                             ELSE '' END AS iso_text,
           CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 3 THEN NULL ELSE ts END AS parsed
    FROM events""")
def q_parse_utc_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    ev = tb.table(spark, sf, "events").select("event_id", "ts")
    k = F.col("event_id") % 4
    text = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
             .when(k == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
             .otherwise(F.lit("")))
    return ev.select("event_id", text.alias("iso_text")).select(
        "event_id", "iso_text", worklist.parse_utc_timestamp("iso_text").alias("parsed"))


@register("month_windows", """
    SELECT CAST(m AS DATE) AS month_start, last_day(CAST(m AS DATE)) AS month_end,
           strftime(m, '%Y-%m') AS year_month
    FROM (SELECT unnest(generate_series(TIMESTAMP '1874-01-01',
                 (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem), INTERVAL 1 MONTH)) AS m)""")
def q_month_windows(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.month_windows(tb.table(spark, sf, "lineitem"), "l_shipdate")


@register("accept_pages", W("SELECT mth AS month, page, n_results, total_pages FROM accepted_pages"))
def q_accept_pages(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.accept_pages(testbed.discover_landing(spark, sf, empty_pages=True)).select(
        "month", "page", "n_results", "total_pages")


@register("truncated_months", W("""
    SELECT mth AS month, max(total_pages) AS total_pages, max(total_results) AS total_results,
           count(*) AS pages_landed, max(total_pages) > 500 AS truncated
    FROM page_facts GROUP BY mth"""))
def q_truncated_months(spark: SparkSession, sf: str) -> DataFrame:
    return worklist.truncated_months(testbed.discover_landing(spark, sf))


@register("changed_ids_resync", W("""
    SELECT movie_id FROM o_silver_movie WHERE movie_id IN (SELECT movie_id FROM change_rows)"""))
def q_changed_ids_resync(spark: SparkSession, sf: str) -> DataFrame:
    catalog_ids = silver.silver_movie(testbed.movie_raw(spark, sf))
    return worklist.changed_ids_resync(catalog_ids, bronze.change_list_rows(testbed.changes_landing(spark, sf)))


@register("backfill_windows", """
    SELECT CAST(s AS DATE) AS window_start, least(CAST(s AS DATE) + 13, b.e) AS window_end
    FROM (SELECT min(CAST(ts AS DATE)) AS st, max(CAST(ts AS DATE)) AS e FROM events) b,
         LATERAL (SELECT unnest(generate_series(CAST(b.st AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 14 DAY))
                  AS s)""")
def q_backfill_windows(spark: SparkSession, sf: str) -> DataFrame:
    bounds = tb.table(spark, sf, "events").agg(F.min(F.to_date("ts")).alias("s"), F.max(F.to_date("ts")).alias("e"))
    return worklist.backfill_windows(bounds, "s", "e")


@register("export_worklist", W(f"""
    SELECT p_partkey AS movie_id FROM part
    WHERE p_partkey NOT IN (SELECT movie_id FROM found_details) ORDER BY movie_id"""))
def q_export_worklist(spark: SparkSession, sf: str) -> DataFrame:
    root = _write_exports(spark, sf)
    newest = bronze.read_id_export(spark, bronze.newest_export(spark, f"{root}/movie_ids_*"))
    return worklist.export_worklist(newest, _found_details(spark, sf))


_CHANGES_ASKED = ("2023-11-20", "2024-02-10")    # since when change lists are followed, and until when


@register("missing_change_windows", W(f"""
    SELECT CAST(w AS DATE) AS window_start, least(CAST(w AS DATE) + {worklist.BACKFILL_DAYS - 1}, e) AS window_end FROM (
      SELECT s, e, unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL {worklist.BACKFILL_DAYS} DAY)) AS w FROM (
        SELECT min(d) AS s, max(d) AS e FROM (
          SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS stretch FROM (
            SELECT CAST(x AS DATE) AS d FROM (SELECT unnest(generate_series(TIMESTAMP '{_CHANGES_ASKED[0]}', TIMESTAMP '{_CHANGES_ASKED[1]}', INTERVAL 1 DAY)) AS x)
            WHERE CAST(x AS DATE) NOT IN (
              SELECT change_date FROM change_rows GROUP BY change_date
              HAVING day(change_date) NOT IN {tb.UNLANDED_CHANGES} AND NOT (day(change_date) = {tb.CUT_CHANGES[0]} AND max(page) >= {tb.CUT_CHANGES[1]}))))
        GROUP BY stretch))"""))
def q_missing_change_windows(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "changes")
    landing.write_landing(testbed.changes_landing(spark, sf, with_gaps=True), f"{base}/landing/changes")
    for _ in range(2):       # the second call finds every run taken in
        jobs.load_changes(spark, f"{base}/landing/changes", f"{base}/catalog")
    return jobs.missing_changes(spark, f"{base}/catalog", *_CHANGES_ASKED)


@register("refresh_changed", W(f"""
    SELECT p_partkey AS movie_id, TIMESTAMP '{tb.FIRST_DETAILS_AT}' AS ingested_at, p_name AS title FROM part
    UNION ALL
    SELECT p_partkey, TIMESTAMP '{tb.REFETCHED_AT}', upper(p_name) FROM part WHERE p_partkey IN (
      SELECT movie_id FROM landed_changes GROUP BY movie_id HAVING max(change_date) >= DATE '{tb.FIRST_DETAILS_AT[:10]}')"""))
def q_refresh_changed(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "refresh")
    root, land = f"{base}/catalog", f"{base}/landing"
    parts = tb.table(spark, sf, "part").select(F.col("p_partkey").alias("movie_id"))
    landing.write_landing(testbed.refetched_details_landing(spark, sf, tb.FIRST_DETAILS_AT, F.col("p_name")), f"{land}/details")
    jobs._append_worklist(spark, f"{land}/details", root, "movie_details_raw", parts, bronze.land_detail_rows)
    landing.write_landing(testbed.changes_landing(spark, sf, with_gaps=True), f"{land}/changes")
    # all movies are fetched again, but only those that changed are taken
    landing.write_landing(testbed.refetched_details_landing(spark, sf, tb.REFETCHED_AT, F.upper("p_name")), f"{land}/details", mode="append")
    for _ in range(2):       # the second call finds nothing stale
        jobs.refresh_changed(spark, land, root)
    return jobs.read_bronze(spark, root).details.select("movie_id", "ingested_at", json_string("raw_json", "title").alias("title"))


# ---- 2.3 / 2.4 extra models ---------------------------------------------------------------
@register("stg_movie_credits", W("""
    SELECT movie_id, person_id, name, 'cast' AS credit_type, character, cast_order,
           CAST(NULL AS VARCHAR) AS job, CAST(NULL AS VARCHAR) AS department FROM o_silver_movie_cast
    UNION ALL
    SELECT movie_id, person_id, name, 'crew', NULL, NULL, job, department FROM o_silver_movie_crew"""))
def q_stg_movie_credits(spark: SparkSession, sf: str) -> DataFrame:
    b = _b(spark, sf)
    return silver.stg_movie_credits(silver.silver_movie_cast(b.credits), silver.silver_movie_crew(b.credits))


@register("fact_movie_popularity", W("SELECT * FROM o_fact_movie_popularity"))
def q_fact_movie_popularity(spark: SparkSession, sf: str) -> DataFrame:
    b = _b(spark, sf)
    return gold.fact_movie_popularity(b.movie, silver.silver_movie_details(b.details))


def _popularity_days(spark: SparkSession, sf: str) -> DataFrame:
    """The stored days after three runs: all days but two, then the newest one, then one that comes late."""
    root, movie = scratch_dir(spark, "popularity"), _b(spark, sf).movie
    path = scratch_dir(spark, "snapshot-days")
    movie.select(F.to_date("ingested_at").alias("snapshot_date")).distinct().coalesce(1).write.parquet(path)
    days = spark.read.schema("snapshot_date date").parquet(path)
    newest = days.agg(F.max("snapshot_date").alias("d"))
    late = days.join(days.agg(F.min("snapshot_date").alias("m")), F.col("snapshot_date") > F.date_add("m", 30)).agg(F.min("snapshot_date").alias("d"))
    apart = newest.unionByName(late)
    popularity_days.refresh_days(movie, root, days.join(apart, days.snapshot_date == apart.d, "left_anti"))
    for day in (newest, late):
        popularity_days.refresh_days(movie, root, day.withColumnRenamed("d", "snapshot_date"))
    return popularity_days.read_days(spark, root)


@register("popularity_by_day", W("""
    SELECT movie_id, snapshot_date, popularity, vote_average, vote_count, revenue,
           popularity - lag(popularity) OVER (PARTITION BY movie_id ORDER BY snapshot_date) AS popularity_change
    FROM o_fact_movie_popularity"""))
def q_popularity_by_day(spark: SparkSession, sf: str) -> DataFrame:
    days, details = _popularity_days(spark, sf), silver.silver_movie_details(_b(spark, sf).details)
    return popularity_days.fact_movie_popularity(days, details)


# ---- 2.5 data tests --------------------------------------------------------------------------
_SHARED_BRONZE = {   # bronze table -> (its field of Bronze, the silver models that read it)
    "movie_credits_raw": ("credits", {"silver_movie_cast", "silver_movie_crew"}),
    "movie_raw": ("movie", {"silver_movie", "silver_bridge_movie_genre"}),
}


def _bronze_steps(spark: SparkSession, sf: str, root: str, silver_names) -> tuple[catalog.Bronze, dict]:
    """Bronze for the named silver models, and the steps (``jobs.materialize_all``) that write what two of them read."""
    b, shared = _b(spark, sf), {}

    def write(table, field):
        shared[field] = spark.read.parquet(bronze.bronze_append(getattr(b, field), jobs.table_path(root, "bronze", table)))

    steps = {t: (set(), lambda t=t, f=f: write(t, f)) for t, (f, readers) in _SHARED_BRONZE.items() if readers <= set(silver_names)}
    stored = {_SHARED_BRONZE[t][0] for t in steps}
    return catalog.Bronze(factory={f: lambda f=f: shared[f] if f in stored else getattr(b, f)
                                   for f in ("genre", "movie", "details", "credits")}), steps


def stored_bronze(spark: SparkSession, sf: str, root: str, silver_names) -> catalog.Bronze:
    """Bronze for the named silver models.  A table that two of them read is written once and read back, so
    its responses are built and parsed once and the models read the paths they use."""
    b, steps = _bronze_steps(spark, sf, root, silver_names)
    jobs.materialize_all(steps)
    return b


def written_models(spark: SparkSession, sf: str, names=None) -> dict[str, DataFrame]:
    """Models (all by default) and what they rest on, written once per layer and read back: what the data tests and
    discovery run on.  Each is built as soon as what it reads is written, several at a time: the last tasks of one
    leave cores to the next."""
    names = list(catalog.MODEL_LAYERS if names is None else names)
    root = scratch_dir(spark, "catalog")
    gold_names = catalog.gold_inputs(names)
    silver_names = set().union(*(catalog.silver_inputs(n) for n in [*names, *gold_names]))
    b, steps = _bronze_steps(spark, sf, root, silver_names)
    plans, tables = catalog.silver_models(b), {}

    def make(name):
        layer = catalog.MODEL_LAYERS[name]
        df = catalog.GOLD_BUILDERS[name](tables) if name in catalog.GOLD else plans[name]
        jobs.materialize_table(df, root, layer, name)
        tables[name] = jobs.read_table(spark, root, layer, name)

    needs = {n: {t for t, (_, readers) in _SHARED_BRONZE.items() if t in steps and n in readers} for n in catalog.SILVER_BUILDERS if n in silver_names}
    needs |= {n: set(catalog.GOLD[n][1]) for n in gold_names}
    jobs.materialize_all(steps | {n: (inputs, lambda n=n: make(n)) for n, inputs in needs.items()})
    return {n: tables[n] for n in needs}


@register("quality_report", W(quality.oracle_tests_sql()))
def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(written_models(spark, sf))


for _key, _kind in (("test_not_null", "not_null"), ("test_unique", "unique"), ("test_unique_combination", "combination")):
    def _q(spark: SparkSession, sf: str, _kind=_kind) -> DataFrame:
        names = [t for t, tests in quality.DECLARED_TESTS.items() if tests.get(_kind)]
        return quality.run_tests(written_models(spark, sf, names), kinds=(_kind,))
    _q.__name__ = f"q_{_key}"
    register(_key, W(quality.oracle_tests_sql((_kind,))))(_q)


# ---- 2.6 discovery -------------------------------------------------------------------------------
@register("top_popular_movies", W(f"""
    SELECT movie_id, title, popularity FROM o_dim_movie
    ORDER BY popularity DESC NULLS LAST, movie_id LIMIT {TOP_N}"""))
def q_top_popular_movies(spark: SparkSession, sf: str) -> DataFrame:
    return discover.top_popular_movies(_m(spark, sf)["dim_movie"], TOP_N)


@register("rating_by_genre", W("""
    SELECT g.genre_id, g.genre_name, count(*) AS movies, round(avg(m.vote_average), 4) AS avg_vote_average,
           min(m.vote_average) AS min_vote_average, max(m.vote_average) AS max_vote_average
    FROM o_bridge_movie_genre b JOIN o_dim_movie m ON b.movie_id = m.movie_id
    JOIN o_dim_genre g ON g.genre_id = b.genre_id
    WHERE m.vote_count > 0 GROUP BY g.genre_id, g.genre_name"""))
def q_rating_by_genre(spark: SparkSession, sf: str) -> DataFrame:
    m = _m(spark, sf)
    return discover.rating_by_genre(m["dim_movie"], m["bridge_movie_genre"], m["dim_genre"])


@register("dominant_genre_by_year", W("""
    SELECT release_year, genre_id, genre_name, movies FROM (
      SELECT *, rank() OVER (PARTITION BY release_year ORDER BY movies DESC) AS rk FROM (
        SELECT CAST(year(m.release_date) AS INTEGER) AS release_year, g.genre_id, g.genre_name, count(*) AS movies
        FROM o_bridge_movie_genre b JOIN o_dim_movie m ON b.movie_id = m.movie_id
        JOIN o_dim_genre g ON g.genre_id = b.genre_id
        WHERE m.release_date IS NOT NULL GROUP BY 1, 2, 3)) WHERE rk = 1"""))
def q_dominant_genre_by_year(spark: SparkSession, sf: str) -> DataFrame:
    m = _m(spark, sf)
    return discover.dominant_genre_by_year(m["dim_movie"], m["bridge_movie_genre"], m["dim_genre"])


@register("top_rated_movies", W(f"""
    SELECT movie_id, title, vote_average, vote_count FROM o_dim_movie WHERE vote_count >= {MIN_VOTES}
    ORDER BY vote_average DESC NULLS LAST, vote_count DESC, movie_id LIMIT {TOP_N}"""))
def q_top_rated_movies(spark: SparkSession, sf: str) -> DataFrame:
    return discover.top_rated_movies(_m(spark, sf)["dim_movie"], MIN_VOTES, TOP_N)


@register("popularity_over_time", W("""
    SELECT movie_id, snapshot_date, popularity,
           popularity - lag(popularity) OVER (PARTITION BY movie_id ORDER BY snapshot_date) AS popularity_change
    FROM o_fact_movie_popularity"""))
def q_popularity_over_time(spark: SparkSession, sf: str) -> DataFrame:
    b = _b(spark, sf)
    return discover.popularity_over_time(gold.fact_movie_popularity(b.movie, silver.silver_movie_details(b.details)))


@register("browse_catalog", W(f"""
    SELECT movie_id, title, release_date, popularity, vote_average FROM o_dim_movie
    WHERE popularity >= {BROWSE['min_popularity']} AND vote_average >= {BROWSE['min_rating']}
      AND year(release_date) BETWEEN {BROWSE['year_from']} AND {BROWSE['year_to']}
      AND movie_id IN (SELECT movie_id FROM o_bridge_movie_genre WHERE genre_id = {BROWSE['genre_id']})"""))
def q_browse_catalog(spark: SparkSession, sf: str) -> DataFrame:
    m = written_models(spark, sf, ["dim_movie", "bridge_movie_genre"])   # the order reads the movies three times: bounds, sample, rows
    movies = spark.read.parquet(search_index.write_browse_order(m["dim_movie"], scratch_dir(spark, "browse")))
    return discover.browse_catalog(movies, m["bridge_movie_genre"], **BROWSE)


def _indexed(spark: SparkSession, sf: str, *names: str) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Written gold models with the named indexes over them."""
    tables = written_models(spark, sf, [*{search_index.INDEXES[n][0] for n in names} | {"dim_movie"}])
    root = scratch_dir(spark, "index")
    jobs.materialize_all({n: (set(), lambda model=model, write=write, path=f"{root}/{n}": write(tables[model], path))
                          for n, (model, write) in search_index.INDEXES.items() if n in names})
    return tables, [spark.read.parquet(f"{root}/{n}") for n in names]


@register("genres_all", W(f"""
    SELECT movie_id, title FROM o_dim_movie WHERE movie_id IN (
      SELECT movie_id FROM o_bridge_movie_genre WHERE genre_id IN ({", ".join(map(str, GENRE_SET))})
      GROUP BY movie_id HAVING count(DISTINCT genre_id) = {len(GENRE_SET)})"""))
def q_genres_all(spark: SparkSession, sf: str) -> DataFrame:
    m, (bitmaps,) = _indexed(spark, sf, "genre_bitmaps")
    return discover.genres_all(m["dim_movie"], None, GENRE_SET, bitmaps)


@register("genres_any", W(f"""
    SELECT movie_id, title FROM o_dim_movie WHERE movie_id IN (
      SELECT movie_id FROM o_bridge_movie_genre WHERE genre_id IN ({", ".join(map(str, GENRE_SET))}))"""))
def q_genres_any(spark: SparkSession, sf: str) -> DataFrame:
    m, (bitmaps,) = _indexed(spark, sf, "genre_bitmaps")
    return discover.genres_any(m["dim_movie"], None, GENRE_SET, bitmaps)


@register("title_search", W(f"""
    SELECT movie_id, title, release_date, adult FROM o_dim_movie
    WHERE contains(lower(title), '{TITLE_QUERY}') AND NOT COALESCE(adult, false)"""))
def q_title_search(spark: SparkSession, sf: str) -> DataFrame:
    m, (grams,) = _indexed(spark, sf, "dim_movie_title_grams")
    return discover.title_search(m["dim_movie"], TITLE_QUERY, postings=grams)


@register("multi_search", W(f"""
    SELECT 'movie' AS media_type, movie_id AS id, title AS name FROM o_dim_movie
    WHERE contains(lower(title), '{MULTI_QUERY}')
    UNION ALL
    SELECT 'person', person_id, name FROM o_dim_person WHERE contains(lower(name), '{MULTI_QUERY}')"""))
def q_multi_search(spark: SparkSession, sf: str) -> DataFrame:
    m, (titles, names) = _indexed(spark, sf, "dim_movie_title_grams", "dim_person_name_grams")
    return discover.multi_search(m["dim_movie"], m["dim_person"], MULTI_QUERY, titles, names)


# ---- 2.7 jobs and streams ----------------------------------------------------------------------
@register("build_catalog", W(quality.oracle_tests_sql()))
def q_build_catalog(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "catalog")
    return jobs.build_catalog(spark, stored_bronze(spark, sf, root, catalog.SILVER_BUILDERS), root)


def write_test_landing(spark: SparkSession, sf: str, root: str, kinds=("genre", "discover", "details", "credits")) -> str:
    """Land the test bed's responses as gzipped JSON-line files, one folder per kind and fetch run."""
    make = {"genre": testbed.genre_landing, "discover": testbed.discover_landing, "details": testbed.details_landing,
            "credits": testbed.credits_landing}
    for kind in kinds:
        landing.write_landing(make[kind](spark, sf, as_body=testbed.unparsed), f"{root}/{kind}", "gzip")
    return root


_DAILY_SQL = W(f"""
    SELECT m.movie_id,
           COALESCE(d.title, m.title) AS title, m.original_title,
           COALESCE(d.original_language, m.original_language) AS original_language,
           COALESCE(d.overview, m.overview) AS overview,
           COALESCE(d.release_date, m.release_date) AS release_date,
           COALESCE(d.popularity, m.popularity) AS popularity,
           COALESCE(d.vote_average, m.vote_average) AS vote_average,
           COALESCE(d.vote_count, m.vote_count) AS vote_count,
           COALESCE(d.adult, m.adult) AS adult,
           d.imdb_id, d.tagline, d.status, d.runtime, d.budget, d.revenue
    FROM (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY movie_id
                                     ORDER BY ingested_at DESC, {O._desc(O.MOVIE_COLS + ["endpoint"])}) AS rn_m
        FROM (SELECT r.* EXCLUDE (ingested_at), r.page_fetched_at AS ingested_at
              FROM landed_movie_rows r)) WHERE rn_m = 1) m
    LEFT JOIN (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY movie_id
                                     ORDER BY ingested_at DESC, {O._desc(O.DETAILS_COLS + ["endpoint"])}) AS rn_d
        FROM details_rows
        WHERE movie_id IN (SELECT r.movie_id FROM landed_movie_rows r WHERE r.popularity >= 1))
      WHERE rn_d = 1) d ON m.movie_id = d.movie_id""")


@register("daily_increment", _DAILY_SQL)
def q_daily_increment(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "daily")
    land = write_test_landing(spark, sf, f"{base}/landing")
    jobs.daily_increment(spark, land, f"{base}/catalog")
    return jobs.read_table(spark, f"{base}/catalog", "gold", "dim_movie")


@register("full_backfill", W("""
    SELECT movie_id, title, original_title, original_language, overview, release_date, popularity, vote_average,
           vote_count, adult, endpoint, ingested_at FROM (
      SELECT r.* EXCLUDE (ingested_at), r.page_fetched_at AS ingested_at,
             row_number() OVER (PARTITION BY r.movie_id ORDER BY r.page_fetched_at DESC,
               title DESC NULLS LAST, original_title DESC NULLS LAST, original_language DESC NULLS LAST,
               overview DESC NULLS LAST, release_date DESC NULLS LAST, popularity DESC NULLS LAST,
               vote_average DESC NULLS LAST, vote_count DESC NULLS LAST, adult DESC NULLS LAST) AS rn2
      FROM landed_movie_rows r) WHERE rn2 = 1"""))
def q_full_backfill(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "backfill")
    write_test_landing(spark, sf, base, ("discover",))
    jobs.full_backfill(spark, f"{base}/discover", f"{base}/catalog")
    return jobs.full_backfill(spark, f"{base}/discover", f"{base}/catalog")   # a repeated call loads nothing


def write_event_landing(spark: SparkSession, sf: str, path: str, files: int = 4) -> str:
    ev = tb.table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                              "user_id", "event_type", "value", "props"))
    ev.select(line.alias("value")).repartitionByRange(files, "event_id").write.text(path)
    return path


@register("stream_bronze_append", W("""
    SELECT 'events' AS table_name, CAST(event_id AS BIGINT) AS id, ts AS ingested_at, count(*) AS n FROM events GROUP BY event_id, ts
    UNION ALL SELECT 'discover', movie_id, CAST(r.mth + INTERVAL 1 MONTH AS TIMESTAMP), count(*)
      FROM page_rows r JOIN streamed_pages s ON r.mth = s.mth AND r.page = s.page GROUP BY movie_id, r.mth
    UNION ALL SELECT 'details', movie_id, ingested_at, count(*) FROM details_rows GROUP BY movie_id, ingested_at
    UNION ALL SELECT 'credits', movie_id, ingested_at, 1 FROM (SELECT DISTINCT movie_id, ingested_at FROM credit_rows)"""))
def q_stream_bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "stream-append")
    write_test_landing(spark, sf, f"{base}/landing", ("details", "credits"))
    write_event_landing(spark, sf, f"{base}/landing/events")
    # discover: an empty page, one that never lands, and one of every month that lands last
    page = F.col("body.page")
    pages = testbed.discover_landing(spark, sf, empty_pages=True, as_body=testbed.unparsed).where(
        ~((F.month("request_date") == tb.LOST_PAGE[0]) & (page == tb.LOST_PAGE[1])))
    landing.write_lines(pages.select(landing.landing_line().alias("value"), "run_id", (page == tb.LATE_PAGE).alias("late")),
                        f"{base}/landing/discover", "gzip", above=("late",))
    folders = {kind: f"{base}/landing/{kind}" for kind in ("events", *bronze_stream.LANDINGS)}
    late_pages = spark.read.schema("value string, late boolean, run_id string").text(folders["discover"]).where("late")
    folders["discover"] += "/late=false"
    parts = []
    for kind in ("events", *bronze_stream.LANDINGS):
        to_bronze = bronze_stream.event_bronze if kind == "events" else bronze_stream.envelope_bronze(kind)
        for drain in range(2):       # but for the late pages the second drain finds nothing new: exactly once
            if kind == "discover" and drain:
                landing.write_lines(late_pages, folders[kind], "gzip", mode="append")
            bronze_stream.stream_bronze_append(spark, folders[kind], f"{base}/bronze/{kind}", f"{base}/_checkpoint/{kind}", to_bronze)
        b = spark.read.parquet(f"{base}/bronze/{kind}")
        parts.append(b.groupBy(F.col(b.columns[0]).alias("id"), "ingested_at").agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(kind).alias("table_name"), "id", "ingested_at", "n"))
    return reduce(DataFrame.unionByName, parts)


@register("stream_latest_upsert", """
    SELECT user_id, event_id, event_type, value, ingested_at FROM (
      SELECT user_id, event_id, event_type, value, ts AS ingested_at,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC NULLS LAST,
                                event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
      FROM events) WHERE rn = 1""")
def q_stream_latest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_dir(spark, "stream-upsert")
    src = write_event_landing(spark, sf, f"{base}/landing")
    for _ in range(2):       # a restart finds nothing new
        latest = bronze_stream.stream_latest(spark, src, f"{base}/table", f"{base}/_checkpoint", max_files_per_trigger=1)
    return latest


# ---- 2.3 silver building blocks (C1-C9) -------------------------------------------------------
@register("json_path_cast", W("""
    SELECT movie_id, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, title, popularity, vote_count, adult,
           CASE WHEN l_linenumber = 1 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS release_text
    FROM movie_rows"""))
def q_json_path_cast(spark: SparkSession, sf: str) -> DataFrame:
    r = "raw_json"
    return testbed.movie_raw(spark, sf).select(
        json_bigint(r, "id").alias("movie_id"), json_bigint(r, "l_orderkey").alias("l_orderkey"),
        json_bigint(r, "l_linenumber").alias("l_linenumber"), json_string(r, "title").alias("title"),
        json_double(r, "popularity").alias("popularity"), json_bigint(r, "vote_count").alias("vote_count"),
        F.variant_get(r, "$.adult", "boolean").alias("adult"),
        json_string(r, "release_date").alias("release_text"))


@register("blank_to_null", W("SELECT movie_id, ingested_at, imdb_id, tagline FROM details_rows"))
def q_blank_to_null(spark: SparkSession, sf: str) -> DataFrame:
    from cinelake.functions.jsonops import blank_to_null
    d = _b(spark, sf).details
    return d.select("movie_id", "ingested_at", blank_to_null(json_string("raw_json", "imdb_id")).alias("imdb_id"),
                    blank_to_null(json_string("raw_json", "tagline")).alias("tagline"))


@register("blank_date_to_null", W("SELECT movie_id, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                                   "release_date FROM movie_rows"))
def q_blank_date_to_null(spark: SparkSession, sf: str) -> DataFrame:
    from cinelake.functions.jsonops import json_date
    r = "raw_json"
    return testbed.movie_raw(spark, sf).select(
        json_bigint(r, "id").alias("movie_id"), json_bigint(r, "l_orderkey").alias("l_orderkey"),
        json_bigint(r, "l_linenumber").alias("l_linenumber"), json_date(r, "release_date").alias("release_date"))


@register("flatten_scalar_array", W("""
    SELECT movie_id, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, genre_a AS genre_id FROM movie_rows
    UNION ALL SELECT movie_id, l_orderkey, CAST(l_linenumber AS BIGINT), genre_b FROM movie_rows"""))
def q_flatten_scalar_array(spark: SparkSession, sf: str) -> DataFrame:
    r = "raw_json"
    return flatten_scalar_array(testbed.movie_raw(spark, sf), r, "genre_ids", "genre_id", json_bigint(r, "id").alias("movie_id"),
                                json_bigint(r, "l_orderkey").alias("l_orderkey"), json_bigint(r, "l_linenumber").alias("l_linenumber"))


@register("flatten_struct_array", W("""
    SELECT movie_id, ingested_at, doc_pos AS pos,
           l_suppkey AS person_id, s_name AS name, character, CAST(l_linenumber AS BIGINT) AS cast_order
    FROM credit_rows"""))
def q_flatten_struct_array(spark: SparkSession, sf: str) -> DataFrame:
    c = _b(spark, sf).credits
    flat = flatten_struct_array(c, "raw_json", "cast", json_bigint("raw_json", "id").alias("movie_id"), "ingested_at")
    return flat.select("movie_id", "ingested_at", "pos", json_bigint("e", "id").alias("person_id"),
                       json_string("e", "name").alias("name"), json_string("e", "character").alias("character"),
                       json_bigint("e", "order").alias("cast_order"))


@register("flatten_match_row", W("SELECT genre_id, genre_name, ingested_at FROM genre_rows"))
def q_flatten_match_row(spark: SparkSession, sf: str) -> DataFrame:
    g = _b(spark, sf).genre
    return flatten_match_row(g, "raw_json", "genres", "id", "genre_id", "ingested_at").select(
        "genre_id", json_string("e", "name").alias("genre_name"), "ingested_at")


def _events(spark, sf):
    return tb.table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("event_date"),
                                                "ts", "event_id", "value", "props")


def _latest_sql(keys: list[str]) -> str:
    payload = [c for c in ["user_id", "event_type", "event_date", "event_id", "value", "props"] if c not in keys]
    return f"""
    SELECT user_id, event_type, event_date, ts, event_id, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)}
                                   ORDER BY ts DESC, {O._desc(payload)}) AS rn
      FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS event_date, ts, event_id, value, props FROM events))
    WHERE rn = 1"""


@register("latest_per_key", _latest_sql(["user_id"]))
def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_per_key(_events(spark, sf), ["user_id"], newest="ts")


@register("latest_per_pair", _latest_sql(["user_id", "event_type"]))
def q_latest_per_pair(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_per_key(_events(spark, sf), ["user_id", "event_type"], newest="ts")


@register("latest_per_triple", _latest_sql(["user_id", "event_type", "event_date"]))
def q_latest_per_triple(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.latest_per_key(_events(spark, sf), ["user_id", "event_type", "event_date"], newest="ts")

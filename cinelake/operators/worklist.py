"""Worklists, high-water marks and page acceptance -- SURVEY B1-B12.

Everything returns a DataFrame; nothing is collected to the driver.  A
fetcher consumes the worklists as data (e.g. ``mapInPandas`` over id
ranges), not as a Python list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cinelake.functions.jsonops import json_double, required_array
from cinelake.session import scratch_dir
from cinelake.sources.bronze import change_window, drop_missing_responses

# ---- fixed values -----------------------------------------------------------------
POPULARITY_THRESHOLD = 1.0
DEFAULT_HIGH_WATER_DATE = "2023-06-25"
DEFAULT_HIGH_WATER_TS = "2023-01-01T00:00:00Z"
OVERLAP_MINUTES = 5
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
FIRST_MONTH = "1874-01-01"
API_PAGE_CAP = 500           # pages that the API serves per query
BACKFILL_DAYS = 14
# -------------------------------------------------------------------------------------


def details_worklist(movie_raw: DataFrame, details_raw: DataFrame,
                     threshold: float = POPULARITY_THRESHOLD) -> DataFrame:
    """B1: ids with popularity >= threshold in ANY snapshot, not yet in details.

    ``NOT IN`` over a NOT NULL key equals a left anti join, which can shuffle
    on the key instead of broadcasting the whole details id list; both sides
    are de-duplicated (partial aggregate) before the join.
    """
    wanted = movie_raw.where(json_double("raw_json", "popularity") >= threshold).select("movie_id").distinct()
    have = details_raw.select("movie_id").distinct()
    return wanted.join(have, "movie_id", "left_anti").orderBy("movie_id")


def credits_worklist(details_raw: DataFrame, credits_raw: DataFrame) -> DataFrame:
    """B2: ids in details and not yet in credits."""
    have = credits_raw.select("movie_id").distinct()
    return details_raw.select("movie_id").distinct().join(have, "movie_id", "left_anti").orderBy("movie_id")


def high_water_date(df: DataFrame, column: str, default: str = DEFAULT_HIGH_WATER_DATE) -> DataFrame:
    """``MAX(col)`` as ``yyyy-MM-dd``; the default when empty or all NULL."""
    return df.agg(F.coalesce(F.date_format(F.max(column), "yyyy-MM-dd"), F.lit(default)).alias("high_water"))


def parse_utc_timestamp(c: Column | str) -> Column:
    """ISO-8601 / OData text -> instant (``Z``, fractions, offsets); empty
    or NULL -> NULL; text without an offset is read as UTC.  Returned as
    TIMESTAMP_NTZ in UTC."""
    c = F.col(c) if isinstance(c, str) else c
    instant = F.to_timestamp(F.nullif(F.trim(c), F.lit("")))
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def high_water_timestamp(df: DataFrame, column: str, default: str = DEFAULT_HIGH_WATER_TS,
                         overlap_minutes: int = OVERLAP_MINUTES) -> DataFrame:
    """``MAX(col)`` minus an overlap window as ``...Z``.  The column may be
    a timestamp or ISO text (text is compared as text, then parsed); the
    default is returned without the overlap."""
    dtype = df.schema[column].dataType
    top = F.max(column)
    ts = parse_utc_timestamp(top) if isinstance(dtype, StringType) else top.cast("timestamp_ntz")
    shifted = ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(overlap_minutes))
    return df.agg(F.coalesce(F.date_format(shifted, ISO_Z_FORMAT), F.lit(default)).alias("high_water"))


def month_windows(anchor: DataFrame, column: str, first_month: str = FIRST_MONTH) -> DataFrame:
    """Months from the month of ``max(column)`` DOWN to ``first_month``,
    with first and last day.  One generator row; the sequence length is
    bounded by the calendar (about 1,800 months)."""
    start = anchor.agg(F.trunc(F.max(column), "month").alias("start"))
    months = start.select(F.explode(F.sequence(F.col("start"), F.lit(first_month).cast("date"),
                                               F.expr("INTERVAL -1 MONTH"))).alias("month_start"))
    return months.select("month_start", F.last_day("month_start").alias("month_end"),
                         F.date_format("month_start", "yyyy-MM").alias("year_month"))


def page_facts(landing: DataFrame) -> DataFrame:
    """One row per landed discover page: (month, page, total_pages, total_results, n_results, ...)."""
    results = required_array("body", "results")
    return landing.select(
        "run_id", F.col("request_date").alias("month"),
        F.variant_get("body", "$.page", "int").alias("page"),
        F.coalesce(F.variant_get("body", "$.total_pages", "int"), F.lit(1)).alias("total_pages"),
        F.variant_get("body", "$.total_results", "int").alias("total_results"),
        F.coalesce(F.array_size(results), F.lit(0)).alias("n_results"),
        "endpoint", "http_status", "fetched_at", "body")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def accept_pages(landing: DataFrame, max_pages: int | None = None, stored: bool = False) -> DataFrame:
    """The landed pages that the page loop would have kept, per fetch run
    and month: from page 1 up to the first empty page (excluded), the first
    page >= total_pages (included) and the first gap in the landed page
    numbers (excluded).  Any response but a 200, and one without a page
    number, stops the job before a page is judged.  ``max_pages`` is an
    opt-in cap; a page that landed is data, so there is none by default.

    The first gap is the smallest page whose successor did not land (an anti
    join on run, month and page, so no month is gathered anywhere).  The pages
    are parsed once and written with their numbers while the query is built:
    the judgement reads the number columns alone, the result the bodies.  With
    ``stored`` the landing is a read of landed files, which stand: only the
    numbers are written, and the files are read again for the result.  The
    stop pages are written too, one row per run and month, whose known size
    lets the last join leave the bodies unshuffled.
    """
    pages = page_facts(drop_missing_responses(landing)).withColumn(
        "page", F.coalesce("page", F.raise_error(F.concat(F.lit("no page number in "), F.col("endpoint"))).cast("int")))
    by = ["run_id", "month"]
    numbers = [*by, "page", "n_results", "total_pages"]
    if stored:
        facts = _written(pages.select(*numbers), "page-numbers")
    else:
        pages = _written(pages, "pages")
        facts = pages.select(*numbers)
    landed = facts.select(*by, "page").distinct()
    before = landed.select(*by, (F.col("page") - 1).alias("page"))
    runs_out = landed.join(before, [*by, "page"], "left_anti").groupBy(*by).agg(F.min("page").alias("unbroken"))
    stops = facts.groupBy(*by).agg(
        F.min("page").alias("first"),
        F.min(F.when(F.col("n_results") == 0, F.col("page"))).alias("first_empty"),
        F.min(F.when(F.col("page") >= F.col("total_pages"), F.col("page"))).alias("first_last")).join(runs_out, by)
    # least() skips NULLs; a run whose first page did not land has nothing to accept
    stop = F.least(F.col("first_empty") - 1, "first_last", "unbroken", F.lit(max_pages).cast("int"))
    stops = _written(stops.select(*by, F.when(F.col("first") > 1, F.lit(0)).otherwise(stop).alias("__stop")), "stop-pages")
    return (pages.join(stops, by).where((F.col("page") >= 1) & (F.col("page") <= F.col("__stop")))
                 .drop("__stop"))


def truncated_months(landing: DataFrame, max_pages: int = API_PAGE_CAP) -> DataFrame:
    """Every month window with its reported size and whether that passes
    the API's page cap (the API serves no further page, so the rest of that
    month is missing).  A report only: no landed page is dropped for it."""
    pages = page_facts(landing)
    return pages.groupBy("month").agg(
        F.max("total_pages").alias("total_pages"),
        F.max("total_results").alias("total_results"),
        F.count(F.lit(1)).alias("pages_landed"),
    ).withColumn("truncated", F.col("total_pages") > max_pages)


def changed_ids_resync(catalog_ids: DataFrame, changes: DataFrame) -> DataFrame:
    """Catalogue ids that appear in the change list (left semi join)."""
    return catalog_ids.select("movie_id").distinct().join(changes.select("movie_id"), "movie_id", "left_semi")


def backfill_windows(bounds: DataFrame, start_col: str, end_col: str, days: int = BACKFILL_DAYS) -> DataFrame:
    """Split [start, end] into windows of at most ``days`` days."""
    step = F.expr(f"INTERVAL {days} DAYS")
    w = bounds.select(F.col(end_col).alias("end"),
                      F.explode(F.sequence(F.col(start_col), F.col(end_col), step)).alias("window_start"))
    return w.select("window_start", F.least(F.date_add("window_start", days - 1), F.col("end")).alias("window_end"))


def whole_windows(change_pages: DataFrame) -> DataFrame:
    """Change-list windows of which every page landed: (run_id, window_start, window_end).

    One row per run and window; pages 1 to ``total_pages`` must all be there."""
    start, end = change_window()
    pages = drop_missing_responses(change_pages).select(
        "run_id", start.alias("window_start"), end.alias("window_end"), F.variant_get("body", "$.page", "int").alias("page"),
        F.coalesce(F.variant_get("body", "$.total_pages", "int"), F.lit(1)).alias("total_pages"))
    each = pages.where("page >= 1").groupBy("run_id", "window_start", "window_end", "page").agg(F.max("total_pages").alias("total_pages"))
    windows = each.groupBy("run_id", "window_start", "window_end").agg(
        F.max("total_pages").alias("of"), F.count_if(F.col("page") <= F.col("total_pages")).alias("there"))
    # a list without changes is one page of zero pages in all
    return windows.where(F.col("there") >= F.col("of")).select("run_id", "window_start", "window_end")


def missing_windows(covered: DataFrame, bounds: DataFrame, days: int = BACKFILL_DAYS) -> DataFrame:
    """[first, last] minus the ``covered`` windows (which may overlap), cut into windows of at most ``days`` days.

    Coverage is a set of days, so its size is that of the calendar, whatever has landed: at most
    one row a day, in the window that finds the stretches too."""
    have = covered.select(F.explode(F.sequence("window_start", "window_end")).alias("day")).distinct()
    want = bounds.where(F.col("first") <= F.col("last")).select(F.explode(F.sequence("first", "last")).alias("day"))
    missing = want.join(have, "day", "left_anti")
    stretch = F.date_sub("day", F.row_number().over(Window.orderBy("day")))     # the same for days in a row
    gaps = missing.withColumn("stretch", stretch).groupBy("stretch").agg(F.min("day").alias("s"), F.max("day").alias("e"))
    return backfill_windows(gaps, "s", "e", days)


def refresh_worklist(details_raw: DataFrame, changes: DataFrame) -> DataFrame:
    """Movies with details that changed since: (movie_id, last_changed, after), ``after`` being when the newest details were fetched.

    A change on the day of the fetch may have come after it, so it counts.  Both sides are one row
    per movie before they meet."""
    have = details_raw.groupBy("movie_id").agg(F.max("ingested_at").alias("after"))
    last = changes.groupBy("movie_id").agg(F.max("change_date").alias("last_changed"))
    return have.join(last, "movie_id").where(F.col("last_changed") >= F.to_date("after")).select("movie_id", "last_changed", "after")


def export_worklist(newest_export_rows: DataFrame, details_raw: DataFrame) -> DataFrame:
    """Ids of the newest ID export that are not yet in details.

    The rows are those of the newest day alone: ``bronze.newest_export`` takes
    it from the file names, so no older export is read or parsed."""
    latest = newest_export_rows.select("movie_id").distinct()
    return latest.join(details_raw.select("movie_id").distinct(), "movie_id", "left_anti").orderBy("movie_id")

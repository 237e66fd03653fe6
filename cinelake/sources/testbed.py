"""Test bed: the driver's TPC-H-like tables re-shaped into landed movie-API
responses and bronze rows (FIXTURES.md section 3).

The driver tables hold no movies, so the engine's input is derived from them
with DataFrame expressions only; every frame here grows with the tables it
reads.  DuckDB oracles (``cinelake.oracle``) express the same mapping on the
base tables without JSON.
"""

from __future__ import annotations

import json

from pyspark.errors import PySparkAttributeError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators.ranking import ordered_chunks, ordered_pages, row_number_within
from cinelake.sources.landing import envelope

# ---- fixed values of the test bed -------------------------------------------------
DISCOVER_ENDPOINT = "/discover/movie"
GENRE_ENDPOINT = "/genre/movie/list"
CHANGES_ENDPOINT = "/movie/changes"
GENRE_OLD_AT = "2025-12-01 00:00:00"      # older genre snapshot, names in lower case
GENRE_NEW_AT = "2026-01-01 00:00:00"
DETAILS_OLD_AT = "2026-01-10 00:00:00"    # older details snapshot for p_size <= 20
DETAILS_NEW_AT = "2026-01-15 00:00:00"
DETAILS_MAX_SIZE = 40                      # where some details are not found: parts above it answer 404
DETAILS_OLD_MAX_SIZE = 20
LAGGING_CREDITS_SIZE = 30                  # credits_worklist: credits fetched so far (larger parts still to do)
CREDITS_DOC_SIZE = 1000                    # entries per credits document at most
EMPTY_TITLE_SIZE = 13                      # details title "" beats the discover title
GENRE_MODULUS = 23                         # genre ids 0..22 used, 23 and 24 unused
ORPHAN_GENRE = 99                          # a genre id with no dimension row
PAGE_SIZE = 20                             # discover results per page
CHANGES_PAGE_SIZE = 100
EMPTY_PAGE_MONTH = 6                       # accept_pages: in June the API returns an empty page 2
LOST_PAGE = (9, 3)                         # stream_bronze_append: in September page 3 never lands ...
LATE_PAGE = 2                              # ... and page 2 of every month lands after the others
FIRST_DETAILS_AT = "2024-01-10 12:00:00"   # refresh_changed: when details were fetched first ...
REFETCHED_AT = "2024-02-01 00:00:00"       # ... and again, with titles in upper case
UNLANDED_CHANGES = (5, 15, 25)             # days of the month whose change list never landed
CUT_CHANGES = (20, 2)                      # on that day, that page of the change list did not land
NOT_FOUND_BODY = {"status_code": 34, "status_message": "The resource you requested could not be found.",
                  "success": False}
# -------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give per-row work (JSON building, parsing) every core of the cluster.

    A source with fewer input splits than the default parallelism (one
    Parquet row group is one split) is hash-partitioned on ``keys`` over
    that many partitions (a hash of a well-spread key is even and deterministic
    under task retries without the sort a round-robin split needs); a source
    that already splits well is left alone, so on a large cluster this adds
    no shuffle.
    """
    try:
        n = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= n:
            return df
    except PySparkAttributeError:  # no RDD view (a Connect session): leave the source as is
        return df
    return df.repartition(n, *keys) if keys else df.repartition(n)


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def parsed(document: Column) -> Column:
    """The body of a landing frame: a document as VARIANT."""
    return F.parse_json(F.to_json(document))


def unparsed(document: Column) -> Column:
    """The body of a landing that is only written: a struct, which becomes the same JSON line without being parsed first."""
    return document


def movie_document() -> Column:
    """One discover result element, built from a lineitem joined to its part."""
    c = F.col
    genre_ids = F.when(c("l_linenumber") == 7,
                       F.array(c("l_suppkey") % GENRE_MODULUS, F.lit(ORPHAN_GENRE).cast("bigint"))) \
                 .otherwise(F.array(c("l_suppkey") % GENRE_MODULUS,
                                    (c("l_suppkey") + c("l_linenumber")) % GENRE_MODULUS))
    return F.struct(
        c("l_partkey").alias("id"),
        c("p_name").alias("title"),
        F.concat_ws(" ", c("p_type"), c("p_name")).alias("original_title"),
        F.lower(F.substring(c("p_type"), 1, 2)).alias("original_language"),
        c("p_brand").alias("overview"),
        F.when(c("l_linenumber") == 1, F.lit("")).otherwise(F.date_format(c("l_shipdate"), "yyyy-MM-dd"))
         .alias("release_date"),
        (c("l_extendedprice") / 10000).alias("popularity"),
        (c("l_quantity") / 5).alias("vote_average"),
        c("l_quantity").cast("bigint").alias("vote_count"),
        (c("l_returnflag") == "R").alias("adult"),
        genre_ids.alias("genre_ids"),
        c("l_orderkey"), c("l_linenumber"), c("l_suppkey"),
    )


def _lineitem_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate"), "l_orderkey", "l_linenumber")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey)


def movie_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze movie_raw: one row per lineitem, ingested at its ship date."""
    from cinelake.sources.bronze import bronze_contract
    j = _lineitem_parts(spark, sf_dir)
    return bronze_contract(j.select(
        F.col("l_partkey").alias("movie_id"),
        F.lit(DISCOVER_ENDPOINT).alias("endpoint"),
        F.parse_json(F.to_json(movie_document())).alias("raw_json"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ingested_at"),
    ), "movie_id")


def genre_landing(spark: SparkSession, sf_dir: str, as_body=parsed) -> DataFrame:
    """Two landed genre-list responses (old names lower case, then the real ones).

    A genre list is one API document; it is bounded by the genre vocabulary
    (the nation table, 25 rows), so collecting it per snapshot is safe.
    """
    n = table(spark, sf_dir, "nation")
    snaps = n.select(_ts(GENRE_OLD_AT).alias("at"), F.col("n_nationkey").cast("bigint").alias("id"),
                     F.lower("n_name").alias("name")) \
        .unionByName(n.select(_ts(GENRE_NEW_AT).alias("at"), F.col("n_nationkey").cast("bigint").alias("id"),
                              F.col("n_name").alias("name")))
    docs = snaps.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("id", "name"))).alias("genres"))
    return docs.select(*envelope(F.lit(GENRE_ENDPOINT), F.lit(200), F.col("at"), as_body(F.struct("genres"))))


def _details_document(title: Column) -> Column:
    c = F.col
    return F.struct(
        c("p_partkey").alias("id"),
        F.when(c("p_size") % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("tt"), F.lpad(c("p_partkey").cast("string"), 7, "0"))).alias("imdb_id"),
        title.alias("title"),
        F.when(c("p_size") % 7 == 0, F.lit("")).otherwise(F.concat(c("p_brand"), F.lit(" presents")))
         .alias("tagline"),
        c("p_type").alias("status"),
        c("p_size").alias("runtime"),
        (c("p_partkey") * 1000000).alias("budget"),
        (c("p_partkey") * 2000000).alias("revenue"),
        F.when(c("p_size") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat_ws(" ", c("p_type"), c("p_brand"))).alias("overview"),
        F.when(c("p_size") % 4 == 0, F.lit("")).otherwise(
            F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (c("p_partkey") % 7000).cast("int")),
                          "yyyy-MM-dd")).alias("release_date"),
        (c("p_retailprice") / 100).alias("popularity"),
        (c("p_size") % 2 == 0).alias("adult"),
    )


def _details_at(parts: DataFrame, at: str, title: Column, as_body=parsed) -> DataFrame:
    return parts.select(*envelope(
        F.concat(F.lit("/movie/"), F.col("p_partkey").cast("string")), F.lit(200), _ts(at),
        as_body(_details_document(title)), F.col("p_partkey")))


def _details_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"), "p_partkey")


def details_landing(spark: SparkSession, sf_dir: str, not_found: bool = False, as_body=parsed) -> DataFrame:
    """Landed /movie/{id} responses: one per part, a second, older one for p_size <= 20.

    With ``not_found`` the API does not know parts with p_size > 40 and answers 404 (for the
    queries about missing responses and open worklists)."""
    p = _details_parts(spark, sf_dir)
    new_title = F.when(F.col("p_size") == EMPTY_TITLE_SIZE, F.lit("")).otherwise(F.upper("p_name"))
    new = _details_at(p, DETAILS_NEW_AT, new_title, as_body)
    if not_found:
        known = F.col("p_size") <= DETAILS_MAX_SIZE
        new = _details_at(p.where(known), DETAILS_NEW_AT, new_title).unionByName(p.where(~known).select(*envelope(
            F.concat(F.lit("/movie/"), F.col("p_partkey").cast("string")), F.lit(404), _ts(DETAILS_NEW_AT),
            F.parse_json(F.lit(_json(NOT_FOUND_BODY))), F.col("p_partkey"))))
    return new.unionByName(_details_at(p.where(F.col("p_size") <= DETAILS_OLD_MAX_SIZE), DETAILS_OLD_AT, F.col("p_name"), as_body))


def refetched_details_landing(spark: SparkSession, sf_dir: str, at: str, title: Column) -> DataFrame:
    """Details of every part as one fetch run of its own found them."""
    return _details_at(_details_parts(spark, sf_dir), at, title)


def credits_landing(spark: SparkSession, sf_dir: str, max_size: int | None = None, as_body=parsed) -> DataFrame:
    """Landed /movie/{id}/credits responses: one per part (up to ``max_size``, if given) and ship year.

    cast = suppliers, crew = customers of the part's line items, ordered by
    (l_linenumber, l_orderkey, l_suppkey, l_shipdate); fetched on 1 January.
    A part-year with more than CREDITS_DOC_SIZE entries is split into several
    documents in that order (``ordered_chunks``: a hot part is numbered on many
    tasks and no document grows with the data); chunk k is stamped k
    microseconds before 1 January, so "newest document, then first position"
    still picks the entry that comes first overall.  Customers are joined to
    orders, not to the more numerous line items; the names of suppliers come in last.
    """
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                        "l_returnflag", "l_linestatus", "l_shipdate"),
                "l_orderkey", "l_linenumber")
    p = table(spark, sf_dir, "part")
    p = (p if max_size is None else p.where(F.col("p_size") <= max_size)).select("p_partkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    people = o.join(cu, F.col("o_custkey") == cu.c_custkey).drop("c_custkey")
    items = li.join(p, li.l_partkey == p.p_partkey, "left_semi").withColumn("yr", F.year("l_shipdate"))
    group = ["l_partkey", "yr"]

    def entries(rows: DataFrame) -> DataFrame:
        ordered = rows.join(people, F.col("l_orderkey") == people.o_orderkey).drop("o_orderkey")
        return ordered.repartition(*group).join(s, F.col("l_suppkey") == s.s_suppkey).drop("s_suppkey")

    docs = ordered_chunks(items, entries, group, ["l_linenumber", "l_orderkey", "l_suppkey", "l_shipdate"], CREDITS_DOC_SIZE)
    body = F.struct(F.col("l_partkey").alias("id"),
                    F.transform("rows", lambda x: F.struct(
                        x["l_suppkey"].alias("id"), x["s_name"].alias("name"),
                        F.concat(x["l_returnflag"], x["l_linestatus"]).alias("character"),
                        x["l_linenumber"].alias("order"))).alias("cast"),
                    F.transform("rows", lambda x: F.struct(
                        x["o_custkey"].alias("id"), x["c_name"].alias("name"),
                        x["o_orderpriority"].alias("job"), x["c_mktsegment"].alias("department"))).alias("crew"))
    new_year = F.make_timestamp_ntz(F.col("yr"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    fetched = new_year - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                            (F.col("chunk") / 1000000).cast("decimal(18,6)"))
    return docs.select(*envelope(
        F.concat(F.lit("/movie/"), F.col("l_partkey").cast("string"), F.lit("/credits")),
        F.lit(200), fetched, as_body(body), F.col("l_partkey")))


def discover_landing(spark: SparkSession, sf_dir: str, empty_pages: bool = False, as_body=parsed) -> DataFrame:
    """Landed discover pages, one month window per ship month, 20 results a page.

    Pages are cut in the order of a month's rows; ``ordered_pages`` does it on
    many tasks (a month can hold a large share of all rows), and a page itself
    is bounded (20 results).  With ``empty_pages`` the second page of June
    comes back empty, so only page 1 of June counts (B8).
    """
    j = _lineitem_parts(spark, sf_dir).drop("p_partkey").withColumn("month", F.trunc("l_shipdate", "month").cast("date"))
    # the rows move to their page as they are in the tables; documents, which are wider, are built there
    pages = ordered_pages(j, ["month"], ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"], PAGE_SIZE,
                          movie_document(), total="total_results")
    results = F.col("rows")
    if empty_pages:
        emptied = (F.month("month") == EMPTY_PAGE_MONTH) & (F.col("page") == 2)
        results = F.when(emptied, F.filter(results, lambda x: F.lit(False))).otherwise(results)
    body = F.struct(
        F.col("page"), results.alias("results"),
        F.ceil(F.col("total_results") / PAGE_SIZE).cast("int").alias("total_pages"),
        F.col("total_results").cast("int").alias("total_results"))
    return pages.select(*envelope(
        F.lit(DISCOVER_ENDPOINT), F.lit(200), F.add_months(F.col("month"), 1).cast("timestamp_ntz"),
        as_body(body), None, F.col("month")))


def changes_landing(spark: SparkSession, sf_dir: str, with_gaps: bool = False) -> DataFrame:
    """Landed change-list pages: per day of ``events.ts`` the distinct user ids as
    changed movie ids, 100 per page, ``adult`` when the id is a multiple of 7.  With ``with_gaps``
    the lists of some days are not there, and a page of another."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"), F.col("user_id").alias("id")).distinct()
    ranked = row_number_within(e, ["d"], ["id"], total="total").withColumn(
        "page", ((F.col("rn") - 1) / CHANGES_PAGE_SIZE).cast("int") + 1)
    if with_gaps:
        day = F.dayofmonth("d")
        ranked = ranked.where(~day.isin(*UNLANDED_CHANGES) & ~((day == CUT_CHANGES[0]) & (F.col("page") == CUT_CHANGES[1])))
    pages = ranked.groupBy("d", "page", "total").agg(
        F.sort_array(F.collect_list(F.struct("id", (F.col("id") % 7 == 0).alias("adult")))).alias("results"))
    body = F.struct("results", "page",
                    F.ceil(F.col("total") / CHANGES_PAGE_SIZE).cast("int").alias("total_pages"),
                    F.col("total").cast("int").alias("total_results"))
    return pages.select(*envelope(F.lit(CHANGES_ENDPOINT), F.lit(200), F.date_add("d", 1).cast("timestamp_ntz"),
                                  F.parse_json(F.to_json(body)), None, F.col("d")))


def id_export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ID export lines for part ids: ``{"id", "adult", "video", "popularity"}``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    line = F.to_json(F.struct(F.col("p_partkey").alias("id"), (F.col("p_size") % 2 == 0).alias("adult"),
                              F.lit(False).alias("video"), (F.col("p_retailprice") / 100).alias("popularity")))
    return p.select(line.alias("value"))


def _json(obj) -> str:
    return json.dumps(obj, separators=(",", ":"))

"""Data tests as DataFrames -- SURVEY E1-E4.

A test returns its failure count instead of raising, so the report also
runs after a failed build.  All not-null checks of a table share one
aggregation pass; uniqueness checks are one grouped aggregate each (partial
aggregation keeps a hot value cheap).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: the declared tests (67) -------------------------------------------
DECLARED_TESTS = {
    "silver_genre": {"unique": ["genre_id"], "not_null": ["genre_id", "genre_name", "endpoint", "ingested_at"]},
    "silver_movie": {"unique": ["movie_id"],
                     "not_null": ["movie_id", "title", "original_title", "original_language", "adult", "endpoint",
                                  "ingested_at"]},
    "silver_movie_details": {"unique": ["movie_id"],
                             "not_null": ["movie_id", "title", "status", "original_language", "popularity",
                                          "vote_average", "vote_count", "adult", "endpoint", "ingested_at"]},
    "silver_bridge_movie_genre": {"not_null": ["movie_id", "genre_id"], "combination": [["movie_id", "genre_id"]]},
    "silver_movie_cast": {"not_null": ["movie_id", "person_id", "name", "cast_order"],
                          "combination": [["movie_id", "person_id"]]},
    "silver_movie_crew": {"not_null": ["movie_id", "person_id", "name", "job", "department"],
                          "combination": [["movie_id", "person_id", "job"]]},
    "dim_genre": {"unique": ["genre_id"], "not_null": ["genre_id", "genre_name"]},
    "dim_movie": {"unique": ["movie_id"],
                  "not_null": ["movie_id", "title", "original_title", "original_language", "adult"]},
    "dim_person": {"unique": ["person_id"], "not_null": ["person_id", "name"]},
    "bridge_movie_genre": {"not_null": ["movie_id", "genre_id"], "combination": [["movie_id", "genre_id"]]},
    "bridge_movie_cast": {"not_null": ["movie_id", "person_id", "cast_order"],
                          "combination": [["movie_id", "person_id"]]},
    "bridge_movie_crew": {"not_null": ["movie_id", "person_id", "job", "department"],
                          "combination": [["movie_id", "person_id", "job"]]},
    "fct_movies_by_genre": {"unique": ["genre_id"],
                            "not_null": ["genre_id", "genre_name", "genre_name_clean", "total_movies"]},
}
# -------------------------------------------------------------------------------------

REPORT_COLUMNS = ["table_name", "test_name", "column_names", "failures"]


def test_not_null(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Per column the number of NULL rows -- one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_names"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.explode(pairs).alias("t")).select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("test_name"),
        "t.column_names", F.col("t.failures").cast("bigint").alias("failures"))


def test_unique(df: DataFrame, column: str, table: str = "") -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("test_name"), F.lit(column).alias("column_names"),
        F.col("failures").cast("bigint"))


def test_unique_combination(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Number of column combinations that occur more than once."""
    dup = df.groupBy(*columns).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("unique_combination_of_columns").alias("test_name"),
        F.lit(",".join(columns)).alias("column_names"), F.col("failures").cast("bigint"))


def run_tests(tables: dict[str, DataFrame], kinds=("not_null", "unique", "combination"),
              declared: dict | None = None) -> DataFrame:
    """Every declared test of every given table as one report DataFrame
    (table_name, test_name, column_names, failures)."""
    declared = declared or DECLARED_TESTS
    parts = []
    for table, tests in declared.items():
        if table not in tables:
            continue
        df = tables[table]
        if "not_null" in kinds and tests.get("not_null"):
            parts.append(test_not_null(df, tests["not_null"], table))
        if "unique" in kinds:
            parts += [test_unique(df, c, table) for c in tests.get("unique", [])]
        if "combination" in kinds:
            parts += [test_unique_combination(df, cols, table) for cols in tests.get("combination", [])]
    return reduce(DataFrame.unionByName, parts)


def table_tests(df: DataFrame, tests: dict, table: str) -> DataFrame:
    """Every declared test of one table from ONE grouped aggregate.

    The table is grouped on its declared grain (the unique column or the
    unique combination) while counting NULLs per not-null column; a second,
    one-row aggregate turns that into failure counts.  One shuffle per table
    (partial aggregation keeps a hot value cheap) instead of one per test.
    """
    grains = [[c] for c in tests.get("unique", [])] + [list(c) for c in tests.get("combination", [])]
    if len(grains) != 1:          # no single grain to fuse on: run the tests one by one
        return run_tests({table: df}, declared={table: tests})
    grain, is_unique = grains[0], bool(tests.get("unique"))
    nn = tests.get("not_null", [])
    per = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("__n"),
                                 *[F.count_if(F.col(c).isNull()).alias(f"__nn{i}") for i, c in enumerate(nn)])
    dup = (F.col("__n") > 1) & (F.col(grain[0]).isNotNull() if is_unique else F.lit(True))
    one = per.agg(F.count_if(dup).alias("__dup"),
                  *[F.coalesce(F.sum(f"__nn{i}"), F.lit(0)).alias(f"__nn{i}") for i in range(len(nn))])
    rows = [F.struct(F.lit("not_null").alias("test_name"), F.lit(c).alias("column_names"),
                     F.col(f"__nn{i}").cast("bigint").alias("failures")) for i, c in enumerate(nn)]
    rows.append(F.struct(F.lit("unique" if is_unique else "unique_combination_of_columns").alias("test_name"),
                         F.lit(",".join(grain)).alias("column_names"), F.col("__dup").cast("bigint").alias("failures")))
    return one.select(F.explode(F.array(*rows)).alias("t")).select(
        F.lit(table).alias("table_name"), "t.test_name", "t.column_names", "t.failures")


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All 67 declared tests, one fused aggregate per table; run it also
    when the build failed part way (missing tables are skipped)."""
    parts = [table_tests(tables[t], tests, t) for t, tests in DECLARED_TESTS.items() if t in tables]
    return reduce(DataFrame.unionByName, parts)


def oracle_tests_sql(kinds=("not_null", "unique", "combination"), source=lambda t: f"o_{t}") -> str:
    """The same report as DuckDB SQL over the oracle CTEs."""
    parts = []
    for table, tests in DECLARED_TESTS.items():
        src = source(table)
        if "not_null" in kinds:
            for c in tests.get("not_null", []):
                parts.append(f"SELECT '{table}' AS table_name, 'not_null' AS test_name, '{c}' AS column_names, "
                             f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {src}")
        if "unique" in kinds:
            for c in tests.get("unique", []):
                parts.append(f"SELECT '{table}' AS table_name, 'unique' AS test_name, '{c}' AS column_names, "
                             f"CAST(count(*) AS BIGINT) AS failures FROM "
                             f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        if "combination" in kinds:
            for cols in tests.get("combination", []):
                cs = ", ".join(cols)
                parts.append(f"SELECT '{table}' AS table_name, 'unique_combination_of_columns' AS test_name, "
                             f"'{','.join(cols)}' AS column_names, "
                             f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {cs} FROM {src} GROUP BY {cs} "
                             f"HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)

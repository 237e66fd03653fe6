"""DuckDB oracle SQL for every registered query.

The oracles work on the driver's base tables directly (no JSON), with the
test-bed mapping of ``sources.testbed`` written out in SQL, explicit
``NULLS LAST`` and the same deterministic tie-breaks as the engine.  Every
statement starts with the full list of shared CTEs; DuckDB skips the ones a
statement does not use.
"""

from __future__ import annotations

from cinelake.sources import testbed as tb


def _desc(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


MOVIE_COLS = ["title", "original_title", "original_language", "overview", "release_date", "popularity",
              "vote_average", "vote_count", "adult"]
DETAILS_COLS = ["imdb_id", "title", "tagline", "status", "runtime", "budget", "revenue", "original_language",
                "overview", "release_date", "popularity", "vote_average", "vote_count", "adult"]


def _details_select(title: str, at: str, where: str) -> str:
    return f"""
    SELECT p_partkey AS movie_id,
           CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END AS imdb_id,
           {title} AS title,
           CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand || ' presents' END AS tagline,
           p_type AS status,
           CAST(p_size AS BIGINT) AS runtime,
           CAST(p_partkey AS BIGINT) * 1000000 AS budget,
           CAST(p_partkey AS BIGINT) * 2000000 AS revenue,
           CAST(NULL AS VARCHAR) AS original_language,
           CASE WHEN p_size % 3 = 0 THEN NULL ELSE concat_ws(' ', p_type, p_brand) END AS overview,
           CASE WHEN p_size % 4 = 0 THEN NULL
                ELSE DATE '1990-01-01' + CAST(p_partkey % 7000 AS INTEGER) END AS release_date,
           p_retailprice / 100 AS popularity,
           CAST(NULL AS DOUBLE) AS vote_average,
           CAST(NULL AS BIGINT) AS vote_count,
           p_size % 2 = 0 AS adult,
           '/movie/' || CAST(p_partkey AS VARCHAR) AS endpoint,
           TIMESTAMP '{at}' AS ingested_at
    FROM part WHERE {where}"""


CTES: list[tuple[str, str]] = [
    ("movie_rows", f"""
    SELECT l.l_partkey AS movie_id,
           p.p_name AS title,
           concat_ws(' ', p.p_type, p.p_name) AS original_title,
           lower(substr(p.p_type, 1, 2)) AS original_language,
           p.p_brand AS overview,
           CASE WHEN l.l_linenumber = 1 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS release_date,
           l.l_extendedprice / 10000 AS popularity,
           l.l_quantity / 5 AS vote_average,
           CAST(l.l_quantity AS BIGINT) AS vote_count,
           l.l_returnflag = 'R' AS adult,
           '{tb.DISCOVER_ENDPOINT}' AS endpoint,
           CAST(l.l_shipdate AS TIMESTAMP) AS ingested_at,
           l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate,
           l.l_suppkey % {tb.GENRE_MODULUS} AS genre_a,
           CASE WHEN l.l_linenumber = 7 THEN {tb.ORPHAN_GENRE}
                ELSE (l.l_suppkey + l.l_linenumber) % {tb.GENRE_MODULUS} END AS genre_b
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
    ("o_silver_movie", f"""
    SELECT movie_id, {", ".join(MOVIE_COLS)}, endpoint, ingested_at FROM (
      SELECT *, row_number() OVER (PARTITION BY movie_id
                                   ORDER BY ingested_at DESC, {_desc(MOVIE_COLS + ["endpoint"])}) AS rn
      FROM movie_rows) WHERE rn = 1"""),
    ("genre_rows", f"""
    SELECT CAST(n_nationkey AS BIGINT) AS genre_id, n_name AS genre_name, '{tb.GENRE_ENDPOINT}' AS endpoint,
           TIMESTAMP '{tb.GENRE_NEW_AT}' AS ingested_at FROM nation
    UNION ALL
    SELECT CAST(n_nationkey AS BIGINT), lower(n_name), '{tb.GENRE_ENDPOINT}', TIMESTAMP '{tb.GENRE_OLD_AT}'
    FROM nation"""),
    ("o_silver_genre", f"""
    SELECT genre_id, genre_name, endpoint, ingested_at FROM (
      SELECT *, row_number() OVER (PARTITION BY genre_id
                                   ORDER BY ingested_at DESC, {_desc(["genre_name", "endpoint"])}) AS rn
      FROM genre_rows) WHERE rn = 1"""),
    ("details_rows",
     _details_select(f"CASE WHEN p_size = {tb.EMPTY_TITLE_SIZE} THEN '' ELSE upper(p_name) END", tb.DETAILS_NEW_AT, "true")
     + "\n    UNION ALL" + _details_select("p_name", tb.DETAILS_OLD_AT, f"p_size <= {tb.DETAILS_OLD_MAX_SIZE}")),
    # where the API does not know every part
    ("found_details", f"""
    SELECT d.* FROM details_rows d JOIN part ON movie_id = p_partkey WHERE p_size <= {tb.DETAILS_MAX_SIZE}"""),
    ("o_silver_movie_details", f"""
    SELECT movie_id, {", ".join(DETAILS_COLS)}, endpoint, ingested_at FROM (
      SELECT *, row_number() OVER (PARTITION BY movie_id
                                   ORDER BY ingested_at DESC, {_desc(DETAILS_COLS + ["endpoint"])}) AS rn
      FROM details_rows) WHERE rn = 1"""),
    ("o_silver_bridge_movie_genre", """
    SELECT DISTINCT movie_id, genre_id FROM (
      SELECT movie_id, genre_a AS genre_id FROM movie_rows
      UNION ALL
      SELECT movie_id, genre_b FROM movie_rows)"""),
    ("credit_entries", """
    SELECT l.l_partkey AS movie_id, year(l.l_shipdate) AS yr,
           l.l_linenumber, l.l_orderkey, l.l_suppkey, l.l_shipdate,
           s.s_name, l.l_returnflag || l.l_linestatus AS character,
           o.o_custkey, c.c_name, o.o_orderpriority, c.c_mktsegment
    FROM lineitem l
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey"""),
    ("credit_rows", f"""
    SELECT *, make_timestamp(yr, 1, 1, 0, 0, 0) - to_microseconds(chunk) AS ingested_at,
           CAST((rn - 1) % {tb.CREDITS_DOC_SIZE} AS INTEGER) AS doc_pos FROM (
      SELECT *, CAST((rn - 1) // {tb.CREDITS_DOC_SIZE} AS BIGINT) AS chunk FROM (
        SELECT *, row_number() OVER (PARTITION BY movie_id, yr
                                     ORDER BY l_linenumber, l_orderkey, l_suppkey, l_shipdate) AS rn
        FROM credit_entries))"""),
    ("o_silver_movie_cast", """
    SELECT movie_id, person_id, name, character, cast_order FROM (
      SELECT movie_id, l_suppkey AS person_id, s_name AS name, character,
             CAST(l_linenumber AS BIGINT) AS cast_order,
             row_number() OVER (PARTITION BY movie_id, l_suppkey
                                ORDER BY ingested_at DESC, l_linenumber, l_orderkey, l_suppkey, l_shipdate) AS rn
      FROM credit_rows) WHERE rn = 1"""),
    ("o_silver_movie_crew", """
    SELECT movie_id, person_id, name, job, department FROM (
      SELECT movie_id, o_custkey AS person_id, c_name AS name, o_orderpriority AS job,
             c_mktsegment AS department,
             row_number() OVER (PARTITION BY movie_id, o_custkey, o_orderpriority
                                ORDER BY ingested_at DESC, l_linenumber, l_orderkey, l_suppkey, l_shipdate) AS rn
      FROM credit_rows) WHERE rn = 1"""),
    ("o_dim_genre", "SELECT genre_id, genre_name, upper(genre_name) AS genre_name_clean FROM o_silver_genre"),
    ("o_dim_movie", """
    SELECT m.movie_id,
           COALESCE(d.title, m.title) AS title,
           m.original_title,
           COALESCE(d.original_language, m.original_language) AS original_language,
           COALESCE(d.overview, m.overview) AS overview,
           COALESCE(d.release_date, m.release_date) AS release_date,
           COALESCE(d.popularity, m.popularity) AS popularity,
           COALESCE(d.vote_average, m.vote_average) AS vote_average,
           COALESCE(d.vote_count, m.vote_count) AS vote_count,
           COALESCE(d.adult, m.adult) AS adult,
           d.imdb_id, d.tagline, d.status, d.runtime, d.budget, d.revenue
    FROM o_silver_movie m LEFT JOIN o_silver_movie_details d ON m.movie_id = d.movie_id"""),
    ("o_dim_person", """
    SELECT person_id, min(name) AS name FROM (
      SELECT person_id, name FROM o_silver_movie_cast
      UNION
      SELECT person_id, name FROM o_silver_movie_crew) GROUP BY person_id"""),
    ("o_bridge_movie_genre", "SELECT movie_id, genre_id FROM o_silver_bridge_movie_genre"),
    ("o_bridge_movie_cast", "SELECT movie_id, person_id, character, cast_order FROM o_silver_movie_cast"),
    ("o_bridge_movie_crew", "SELECT movie_id, person_id, job, department FROM o_silver_movie_crew"),
    ("page_rows", f"""
    SELECT *, CAST((rn - 1) // {tb.PAGE_SIZE} + 1 AS INTEGER) AS page FROM (
      SELECT m.*, CAST(date_trunc('month', l_shipdate) AS DATE) AS mth,
             row_number() OVER (PARTITION BY date_trunc('month', l_shipdate)
                                ORDER BY movie_id, l_orderkey, l_linenumber, l_suppkey, l_shipdate) AS rn,
             count(*) OVER (PARTITION BY date_trunc('month', l_shipdate)) AS month_results
      FROM movie_rows m)"""),
    ("page_facts", f"""
    SELECT mth, page, CAST(max(month_results) AS INTEGER) AS total_results,
           CAST(ceil(max(month_results) / {tb.PAGE_SIZE}.0) AS INTEGER) AS total_pages,
           CAST(CASE WHEN month(mth) = {tb.EMPTY_PAGE_MONTH} AND page = 2 THEN 0 ELSE count(*) END AS INTEGER)
             AS n_results
    FROM page_rows GROUP BY mth, page"""),
    ("accepted_pages", """
    SELECT f.* FROM page_facts f JOIN (
      SELECT mth, min(CASE WHEN n_results = 0 THEN page END) AS first_empty,
             min(CASE WHEN page >= total_pages THEN page END) AS first_last
      FROM page_facts GROUP BY mth) s ON f.mth = s.mth
    LEFT JOIN (
      SELECT a.mth, min(a.page) AS first_orphan FROM page_facts a
      WHERE a.page > 1 AND NOT EXISTS (SELECT 1 FROM page_facts b WHERE b.mth = a.mth AND b.page = a.page - 1)
      GROUP BY a.mth) o ON f.mth = o.mth
    WHERE f.page >= 1 AND f.page <= least(coalesce(s.first_empty - 1, f.page), coalesce(s.first_last, f.page),
                                          coalesce(o.first_orphan - 1, f.page))"""),
    # what is left of the pages when one never lands: the same rule over fewer pages
    ("streamed_facts", f"""
    SELECT * FROM page_facts WHERE NOT (month(mth) = {tb.LOST_PAGE[0]} AND page = {tb.LOST_PAGE[1]})"""),
    ("streamed_pages", """
    SELECT f.* FROM streamed_facts f JOIN (
      SELECT mth, min(CASE WHEN n_results = 0 THEN page END) AS first_empty,
             min(CASE WHEN page >= total_pages THEN page END) AS first_last
      FROM streamed_facts GROUP BY mth) s ON f.mth = s.mth
    LEFT JOIN (
      SELECT a.mth, min(a.page) AS first_orphan FROM streamed_facts a
      WHERE a.page > 1 AND NOT EXISTS (SELECT 1 FROM streamed_facts b WHERE b.mth = a.mth AND b.page = a.page - 1)
      GROUP BY a.mth) o ON f.mth = o.mth
    WHERE f.page >= 1 AND f.page <= least(coalesce(s.first_empty - 1, f.page), coalesce(s.first_last, f.page),
                                          coalesce(o.first_orphan - 1, f.page))"""),
    ("landed_movie_rows", """
    SELECT r.*, CAST(r.mth + INTERVAL 1 MONTH AS TIMESTAMP) AS page_fetched_at FROM page_rows r"""),
    ("change_rows", f"""
    SELECT d AS change_date, user_id AS movie_id, user_id % 7 = 0 AS adult,
           CAST((row_number() OVER (PARTITION BY d ORDER BY user_id) - 1) // {tb.CHANGES_PAGE_SIZE} + 1 AS INTEGER)
             AS page
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, user_id FROM events)"""),
    ("landed_changes", f"""
    SELECT * FROM change_rows WHERE day(change_date) NOT IN {tb.UNLANDED_CHANGES}
      AND NOT (day(change_date) = {tb.CUT_CHANGES[0]} AND page = {tb.CUT_CHANGES[1]})"""),
    ("o_fact_movie_popularity", f"""
    SELECT f.movie_id, f.snapshot_date, f.popularity, f.vote_average, f.vote_count, d.revenue FROM (
      SELECT movie_id, CAST(ingested_at AS DATE) AS snapshot_date, popularity, vote_average, vote_count,
             row_number() OVER (PARTITION BY movie_id, CAST(ingested_at AS DATE)
                                ORDER BY ingested_at DESC, {_desc(["popularity", "vote_average", "vote_count"])}) AS rn
      FROM movie_rows) f
    LEFT JOIN o_silver_movie_details d ON f.movie_id = d.movie_id
    WHERE f.rn = 1"""),
    ("o_fct_movies_by_genre", """
    SELECT g.genre_id, g.genre_name, g.genre_name_clean, count(b.movie_id) AS total_movies
    FROM o_dim_genre g LEFT JOIN o_bridge_movie_genre b ON g.genre_id = b.genre_id
    GROUP BY g.genre_id, g.genre_name, g.genre_name_clean"""),
]

_CTE_NAMES = {n for n, _ in CTES}


def with_ctes(select: str) -> str:
    """Prefix ``select`` with only the CTEs it needs (transitively)."""
    needed: list[str] = []
    text = select

    def refs(body: str) -> list[str]:
        import re
        return [n for n in _CTE_NAMES if re.search(rf"\b{n}\b", body)]

    frontier = refs(text)
    seen = set()
    while frontier:
        n = frontier.pop()
        if n in seen:
            continue
        seen.add(n)
        body = dict(CTES)[n]
        frontier.extend(refs(body))
    needed = [n for n, _ in CTES if n in seen]
    if not needed:
        return select.strip()
    return "WITH " + ",\n".join(f"{n} AS ({dict(CTES)[n]}\n)" for n in needed) + "\n" + select.strip()


def model_sql(name: str) -> str:
    return with_ctes(f"SELECT * FROM o_{name}")

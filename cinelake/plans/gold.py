"""Gold star schema -- SURVEY D1-D8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.jsonops import json_bigint, json_double
from cinelake.operators.dedupe import latest_per_key

# dim_movie: columns taken from details first, discover second (fixed list).
DETAILS_FIRST = ["title", "original_language", "overview", "release_date", "popularity", "vote_average",
                 "vote_count", "adult"]
DETAILS_ONLY = ["imdb_id", "tagline", "status", "runtime", "budget", "revenue"]


def dim_genre(silver_genre: DataFrame) -> DataFrame:
    """D1."""
    return silver_genre.select("genre_id", "genre_name", F.upper("genre_name").alias("genre_name_clean"))


def dim_movie(silver_movie: DataFrame, silver_movie_details: DataFrame) -> DataFrame:
    """Discover LEFT JOIN details; details win (even stale, even an empty
    title); movies only in details do not appear.

    In a lazy chain both inputs come out of an aggregate keyed on
    ``movie_id`` and the join adds no exchange.  Over written silver
    (``build_catalog``) both sides are plain Parquet and are shuffled on
    ``movie_id``, or the smaller one is broadcast by AQE from its measured size.
    """
    d = silver_movie_details.select("movie_id", *[F.col(c).alias(f"d_{c}") for c in DETAILS_FIRST + DETAILS_ONLY])
    j = silver_movie.join(d, "movie_id", "left")
    cols = [F.col("movie_id")]
    for c in ["title", "original_title", "original_language", "overview", "release_date", "popularity",
              "vote_average", "vote_count", "adult"]:
        cols.append(F.coalesce(F.col(f"d_{c}"), F.col(c)).alias(c) if c in DETAILS_FIRST else F.col(c))
    cols += [F.col(f"d_{c}").alias(c) for c in DETAILS_ONLY]
    return j.select(*cols)


def dim_person(silver_movie_cast: DataFrame, silver_movie_crew: DataFrame) -> DataFrame:
    """D3: UNION of (id, name) from cast and crew, one row per id with the
    smallest name (NULL only when every name is NULL).  ``min`` aggregates
    partially, so the UNION's duplicate removal is folded into it."""
    both = silver_movie_cast.select("person_id", "name").unionByName(silver_movie_crew.select("person_id", "name"))
    return both.groupBy("person_id").agg(F.min("name").alias("name"))


def bridge_movie_genre(silver_bridge: DataFrame) -> DataFrame:
    """D4."""
    return silver_bridge.select("movie_id", "genre_id")


def bridge_movie_cast(silver_cast: DataFrame) -> DataFrame:
    """Drops the name (it lives in dim_person)."""
    return silver_cast.select("movie_id", "person_id", "character", "cast_order")


def bridge_movie_crew(silver_crew: DataFrame) -> DataFrame:
    """D6."""
    return silver_crew.select("movie_id", "person_id", "job", "department")


def fct_movies_by_genre(dim_genre_df: DataFrame, bridge: DataFrame) -> DataFrame:
    """Movies per genre; unused genres give 0, links to genres missing from
    the dimension vanish.  The bridge is counted per genre first (partial
    aggregate, so a genre holding a third of all links is pre-counted in every
    map task); the join then sees one row per genre on each side."""
    counts = bridge.groupBy("genre_id").agg(F.count("movie_id").alias("total_movies"))
    return (dim_genre_df.join(counts, "genre_id", "left")
            .select("genre_id", "genre_name", "genre_name_clean",
                    F.coalesce(F.col("total_movies"), F.lit(0)).cast("bigint").alias("total_movies")))


def daily_popularity(movie_raw: DataFrame) -> DataFrame:
    """One row per movie and snapshot day: the day's last snapshot, with popularity and votes."""
    snaps = movie_raw.select(
        json_bigint("raw_json", "id").alias("movie_id"),
        F.to_date("ingested_at").alias("snapshot_date"),
        "ingested_at",
        json_double("raw_json", "popularity").alias("popularity"),
        json_double("raw_json", "vote_average").alias("vote_average"),
        json_bigint("raw_json", "vote_count").alias("vote_count"),
    )
    return latest_per_key(snaps, ["movie_id", "snapshot_date"], drop=["ingested_at"])


def fact_movie_popularity(movie_raw: DataFrame, silver_movie_details: DataFrame) -> DataFrame:
    """One row per movie and snapshot day (the day's last snapshot), with
    popularity, votes and the latest known revenue from details."""
    daily = daily_popularity(movie_raw)
    return daily.join(silver_movie_details.select("movie_id", "revenue"), "movie_id", "left")

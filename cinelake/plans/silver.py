"""Silver models -- SURVEY C10-C16.

Each model is a function of bronze DataFrames.  The JSON paths are read
once, the typed scalars are deduplicated with ``latest_per_key``, an
aggregate with a map-side partial step keyed on the model grain (Spark plans
it as a sort aggregate where the payload holds strings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.jsonops import (blank_to_null, flatten_match_row, flatten_scalar_array, flatten_struct_array,
                                        json_bigint, json_bool, json_date, json_double, json_string)
from cinelake.operators.dedupe import latest_per_key


def silver_genre(genre_raw: DataFrame) -> DataFrame:
    """C6 + C7: flatten the whole genre list, keep the element matching the
    row's own ``genre_id`` (bronze column, not JSON), newest per genre."""
    named = flatten_match_row(genre_raw, "raw_json", "genres", "id", "genre_id", "endpoint", "ingested_at").select(
        "genre_id", json_string("e", "name").alias("genre_name"), "endpoint", "ingested_at")
    return latest_per_key(named, ["genre_id"])


def _movie_columns(raw: str = "raw_json") -> list:
    return [
        json_bigint(raw, "id").alias("movie_id"),
        json_string(raw, "title").alias("title"),
        json_string(raw, "original_title").alias("original_title"),
        json_string(raw, "original_language").alias("original_language"),
        json_string(raw, "overview").alias("overview"),
        json_date(raw, "release_date").alias("release_date"),
        json_double(raw, "popularity").alias("popularity"),
        json_double(raw, "vote_average").alias("vote_average"),
        json_bigint(raw, "vote_count").alias("vote_count"),
        json_bool(raw, "adult").alias("adult"),
    ]


def silver_movie(movie_raw: DataFrame) -> DataFrame:
    """C11: typed discover columns, newest snapshot per movie (id from JSON)."""
    typed = movie_raw.select(*_movie_columns(), "endpoint", "ingested_at")
    return latest_per_key(typed, ["movie_id"])


def silver_movie_details(details_raw: DataFrame) -> DataFrame:
    """Typed details columns with blanks -> NULL, newest per movie."""
    r = "raw_json"
    typed = details_raw.select(
        json_bigint(r, "id").alias("movie_id"),
        blank_to_null(json_string(r, "imdb_id")).alias("imdb_id"),
        json_string(r, "title").alias("title"),
        blank_to_null(json_string(r, "tagline")).alias("tagline"),
        json_string(r, "status").alias("status"),
        json_bigint(r, "runtime").alias("runtime"),
        json_bigint(r, "budget").alias("budget"),
        json_bigint(r, "revenue").alias("revenue"),
        json_string(r, "original_language").alias("original_language"),
        json_string(r, "overview").alias("overview"),
        json_date(r, "release_date").alias("release_date"),
        json_double(r, "popularity").alias("popularity"),
        json_double(r, "vote_average").alias("vote_average"),
        json_bigint(r, "vote_count").alias("vote_count"),
        json_bool(r, "adult").alias("adult"),
        "endpoint", "ingested_at",
    )
    return latest_per_key(typed, ["movie_id"])


def silver_bridge_movie_genre(movie_raw: DataFrame) -> DataFrame:
    """C4 + C13: flatten ``genre_ids``; the time column is dropped, so the
    latest row per pair is simply DISTINCT over all snapshots (links accumulate)."""
    return flatten_scalar_array(movie_raw, "raw_json", "genre_ids", "genre_id",
                                json_bigint("raw_json", "id").alias("movie_id")).distinct()


def _credits(credits_raw: DataFrame, array: str) -> DataFrame:
    flat = flatten_struct_array(credits_raw, "raw_json", array, json_bigint("raw_json", "id").alias("movie_id"), "ingested_at")
    return flat.withColumnRenamed("e", "c")


def silver_movie_cast(credits_raw: DataFrame) -> DataFrame:
    """C5 + C14: one row per (movie, person): newest response, then the first
    position in the cast list (an actor with two characters keeps the first)."""
    flat = _credits(credits_raw, "cast").select(
        "movie_id", json_bigint("c", "id").alias("person_id"), json_string("c", "name").alias("name"),
        json_string("c", "character").alias("character"), json_bigint("c", "order").alias("cast_order"),
        "ingested_at", "pos")
    return latest_per_key(flat, ["movie_id", "person_id"], first=["pos"], drop=["ingested_at", "pos"])


def silver_movie_crew(credits_raw: DataFrame) -> DataFrame:
    """C5 + C15: one row per (movie, person, job)."""
    flat = _credits(credits_raw, "crew").select(
        "movie_id", json_bigint("c", "id").alias("person_id"), json_string("c", "name").alias("name"),
        json_string("c", "job").alias("job"), json_string("c", "department").alias("department"),
        "ingested_at", "pos")
    return latest_per_key(flat, ["movie_id", "person_id", "job"], first=["pos"], drop=["ingested_at", "pos"])


def stg_movie_credits(cast: DataFrame, crew: DataFrame) -> DataFrame:
    """Cast and crew in one table, tagged with ``credit_type``."""
    return (cast.withColumn("credit_type", F.lit("cast"))
                .unionByName(crew.withColumn("credit_type", F.lit("crew")), allowMissingColumns=True)
                .select("movie_id", "person_id", "name", "credit_type", "character", "cast_order", "job",
                        "department"))

"""Discovery queries over gold -- SURVEY F1-F9.

The questions come from the project description; exact definitions are
ours, each with a final tie-break on the id so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.plans import search_index


def top_popular_movies(dim_movie: DataFrame, n: int = 10) -> DataFrame:
    """the ``n`` most popular movies (NULL last).  A top-k: each task keeps
    its own k best rows before the single merge (TakeOrderedAndProject)."""
    return (dim_movie.select("movie_id", "title", "popularity")
            .orderBy(F.col("popularity").desc_nulls_last(), F.col("movie_id").asc()).limit(n))


def rating_by_genre(dim_movie: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """per genre, movies with votes and their min / avg / max rating.

    The bridge is joined to the (pre-filtered) movies on movie_id, then
    aggregated per genre with partial aggregation; only the per-genre result
    meets the genre dimension."""
    rated = dim_movie.where(F.col("vote_count") > 0).select("movie_id", "vote_average")
    per_genre = (bridge.join(rated, "movie_id")
                 .groupBy("genre_id")
                 .agg(F.count(F.lit(1)).alias("movies"),
                      F.round(F.avg("vote_average"), 4).alias("avg_vote_average"),
                      F.min("vote_average").alias("min_vote_average"),
                      F.max("vote_average").alias("max_vote_average")))
    return dim_genre.select("genre_id", "genre_name").join(per_genre, "genre_id")


def dominant_genre_by_year(dim_movie: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """per release year the genre(s) with the most movies (ties all kept).

    Counted per year and genre id first; the dimension joins, and the window
    runs, over at most one row per genre in each year."""
    per = (bridge.join(dim_movie.where(F.col("release_date").isNotNull())
                       .select("movie_id", F.year("release_date").alias("release_year")), "movie_id")
           .groupBy("release_year", "genre_id").agg(F.count(F.lit(1)).alias("movies"))
           .join(dim_genre.select("genre_id", "genre_name"), "genre_id"))
    w = Window.partitionBy("release_year").orderBy(F.col("movies").desc())
    return per.withColumn("rk", F.rank().over(w)).where(F.col("rk") == 1).drop("rk")


def top_rated_movies(dim_movie: DataFrame, min_votes: int = 40, n: int = 10) -> DataFrame:
    """highest rating among movies with at least ``min_votes`` votes."""
    return (dim_movie.where(F.col("vote_count") >= min_votes)
            .select("movie_id", "title", "vote_average", "vote_count")
            .orderBy(F.col("vote_average").desc_nulls_last(), F.col("vote_count").desc(), F.col("movie_id"))
            .limit(n))


def popularity_over_time(fact_popularity: DataFrame) -> DataFrame:
    """per movie and snapshot day, popularity and change since the
    previous snapshot.  The fact has one row per movie and day, so a movie's
    window is bounded by the number of days, not by the data volume."""
    w = Window.partitionBy("movie_id").orderBy("snapshot_date")
    return fact_popularity.select(
        "movie_id", "snapshot_date", "popularity",
        (F.col("popularity") - F.lag("popularity").over(w)).alias("popularity_change"))


def browse_catalog(dim_movie: DataFrame, bridge: DataFrame, genre_id: int | None = None,
                   min_popularity: float | None = None, min_rating: float | None = None,
                   year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    """filter by genre, popularity, rating and release year.  The genre
    filter is a left semi join, so a movie never repeats.  Over movies in browse
    order (``search_index.write_browse_order``) the ranges skip row groups."""
    df = dim_movie
    cond = F.lit(True)
    if min_popularity is not None:
        cond = cond & (F.col("popularity") >= min_popularity)
    if min_rating is not None:
        cond = cond & (F.col("vote_average") >= min_rating)
    # whole years as dates: a function of the column would not reach the scan's row-group statistics
    if year_from is not None:
        cond = cond & (F.col("release_date") >= F.make_date(F.lit(year_from), F.lit(1), F.lit(1)))
    if year_to is not None:
        cond = cond & (F.col("release_date") <= F.make_date(F.lit(year_to), F.lit(12), F.lit(31)))
    df = df.where(cond)
    if genre_id is not None:
        df = df.join(bridge.where(F.col("genre_id") == genre_id).select("movie_id"), "movie_id", "left_semi")
    return df.select("movie_id", "title", "release_date", "popularity", "vote_average")


def genres_all(dim_movie: DataFrame, bridge: DataFrame | None, genre_ids: Sequence[int], bitmaps: DataFrame | None = None) -> DataFrame:
    """movies linked to every one of ``genre_ids``; with bitmaps the bridge is not read."""
    if bitmaps is not None:
        return search_index.of_genres(dim_movie, bitmaps, genre_ids, every=True).select("movie_id", "title")
    ids = list(dict.fromkeys(genre_ids))
    hits = (bridge.where(F.col("genre_id").isin(ids)).groupBy("movie_id")
            .agg(F.count_distinct("genre_id").alias("n")).where(F.col("n") == len(ids)))
    return dim_movie.join(hits, "movie_id", "left_semi").select("movie_id", "title")


def genres_any(dim_movie: DataFrame, bridge: DataFrame | None, genre_ids: Sequence[int], bitmaps: DataFrame | None = None) -> DataFrame:
    """movies linked to at least one of ``genre_ids``; with bitmaps the bridge is not read."""
    if bitmaps is not None:
        return search_index.of_genres(dim_movie, bitmaps, genre_ids, every=False).select("movie_id", "title")
    hits = bridge.where(F.col("genre_id").isin(list(genre_ids))).select("movie_id")
    return dim_movie.join(hits, "movie_id", "left_semi").select("movie_id", "title")


def title_search(dim_movie: DataFrame, query: str, year: int | None = None,
                 include_adult: bool = False, postings: DataFrame | None = None) -> DataFrame:
    """F8: case-insensitive substring search on the title, through its trigram postings if given."""
    df = search_index.matching(dim_movie, "movie_id", "title", query, postings)
    if year is not None:
        df = df.where(F.year("release_date") == year)
    if not include_adult:
        df = df.where(~F.coalesce(F.col("adult"), F.lit(False)))
    return df.select("movie_id", "title", "release_date", "adult")


def multi_search(dim_movie: DataFrame, dim_person: DataFrame, query: str,
                 movie_postings: DataFrame | None = None, person_postings: DataFrame | None = None) -> DataFrame:
    """movies and persons matching ``query`` in one result, tagged by type."""
    movies = search_index.matching(dim_movie.select("movie_id", "title"), "movie_id", "title", query, movie_postings).select(
        F.lit("movie").alias("media_type"), F.col("movie_id").alias("id"), F.col("title").alias("name"))
    persons = search_index.matching(dim_person.select("person_id", "name"), "person_id", "name", query, person_postings).select(
        F.lit("person").alias("media_type"), F.col("person_id").alias("id"), "name")
    return movies.unionByName(persons)

"""Hand-written edge rows (FIXTURES.md section 2) through silver and gold."""

import json

from cinelake.plans import gold, silver
from tests.conftest import bronze_df, rows_of

D = "/discover/movie"


def m(id_, at, **kw):
    doc = {"id": id_, "title": kw.pop("title", f"t{id_}"), "original_title": "o", "original_language": "en",
           "overview": "x", "popularity": 1.0, "vote_average": 5.0, "vote_count": 3, "adult": False}
    doc.update(kw)
    doc = {k: v for k, v in doc.items() if v is not Ellipsis}
    return (id_, D, json.dumps(doc), at)


def test_genre_renamed_and_foreign_row(spark):
    doc1 = json.dumps({"genres": [{"id": 28, "name": "Action"}]})
    doc2 = json.dumps({"genres": [{"id": 28, "name": "Action!"}, {"id": 12, "name": "Adventure"}]})
    g = bronze_df(spark, [(28, "/genre/movie/list", doc1, "2024-01-01"), (28, "/genre/movie/list", doc2, "2024-02-01"),
                          (12, "/genre/movie/list", doc2, "2024-02-01"),
                          (99, "/genre/movie/list", doc2, "2024-02-01")], key="genre_id")
    got = rows_of(silver.silver_genre(g), "genre_id", "genre_name")
    assert got == [(12, "Adventure"), (28, "Action!")]          # 99 is not in its own document


def test_movie_release_dates_ties_and_genres(spark):
    raw = bronze_df(spark, [
        m(1, "2024-01-01", title="A", release_date="", genre_ids=[28, 12]),
        m(1, "2024-01-01", title="B", genre_ids=[28]),                      # same time: deterministic pick
        m(2, "2024-01-01", release_date=..., genre_ids=[]),
        m(3, "2024-01-01", release_date=None, genre_ids=None),
        m(4, "2024-01-01", release_date="2020-05-01"),                        # genre_ids absent
        m(5, "2024-01-01", genre_ids=[28, 12]), m(5, "2024-02-01", genre_ids=[28]),   # genre dropped later
    ])
    sm = silver.silver_movie(raw)
    got = {r.movie_id: r for r in sm.collect()}
    assert got[1].title == "B"                         # ("B", ...) > ("A", ...)
    assert got[2].release_date is None and got[3].release_date is None
    assert str(got[4].release_date) == "2020-05-01"
    assert len(got) == 5
    bridge = rows_of(silver.silver_bridge_movie_genre(raw))
    assert bridge == [(1, 12), (1, 28), (5, 12), (5, 28)]   # links accumulate; empty/null/absent give none


def test_dim_movie_details_precedence(spark):
    disc = silver.silver_movie(bronze_df(spark, [m(1, "2024-01-01", title="X"), m(2, "2024-01-01", title="Y")]))
    det_rows = [
        (1, "/movie/1", json.dumps({"id": 1, "title": "", "imdb_id": "", "tagline": "t", "status": "Released",
                                    "budget": 3000000000, "revenue": 6000000000, "popularity": 2.0}), "2024-01-05"),
        (7, "/movie/7", json.dumps({"id": 7, "title": "only details"}), "2024-01-05"),
    ]
    det = silver.silver_movie_details(bronze_df(spark, det_rows))
    dm = {r.movie_id: r for r in gold.dim_movie(disc, det).collect()}
    assert set(dm) == {1, 2}                               # movie only in details does not reach gold
    assert dm[1].title == "" and dm[1].imdb_id is None     # empty details title wins; blank imdb -> NULL
    assert dm[1].budget == 3000000000 and dm[1].revenue == 6000000000
    assert dm[1].popularity == 2.0 and dm[1].vote_average == 5.0   # details first, discover as fallback
    assert dm[2].title == "Y" and dm[2].status is None           # details absent


def test_cast_crew_and_persons(spark):
    credits = json.dumps({"id": 1,
                          "cast": [{"id": 10, "name": "B", "character": "first", "order": 0},
                                   {"id": 10, "name": "B", "character": "second", "order": 1},
                                   {"id": 11, "name": None, "character": "c", "order": 2}],
                          "crew": [{"id": 10, "name": "A", "job": "Director", "department": "D"},
                                   {"id": 10, "name": "A", "job": "Writer", "department": "W"},
                                   {"id": 11, "name": None, "job": "Editor", "department": "E"}]})
    raw = bronze_df(spark, [(1, "/movie/1/credits", credits, "2024-01-01")])
    cast = silver.silver_movie_cast(raw)
    crew = silver.silver_movie_crew(raw)
    assert rows_of(cast, "person_id", "character") == [(10, "first"), (11, "c")]
    assert rows_of(crew, "person_id", "job") == [(10, "Director"), (10, "Writer"), (11, "Editor")]
    persons = dict(rows_of(gold.dim_person(cast, crew)))
    assert persons == {10: "A", 11: None}
    stg = silver.stg_movie_credits(cast, crew)
    assert stg.count() == 5 and set(r.credit_type for r in stg.collect()) == {"cast", "crew"}


def test_fct_movies_by_genre_zero_and_orphans(spark):
    genres = spark.createDataFrame([(28, "Action"), (12, "Adventure")], "genre_id long, genre_name string")
    bridge = spark.createDataFrame([(1, 28), (2, 28), (3, 99)], "movie_id long, genre_id long")
    got = rows_of(gold.fct_movies_by_genre(gold.dim_genre(genres), bridge), "genre_id", "genre_name_clean",
                  "total_movies")
    assert got == [(12, "ADVENTURE", 0), (28, "ACTION", 2)]


def test_fact_movie_popularity_last_of_day(spark):
    raw = bronze_df(spark, [m(1, "2024-01-01 08:00:00", popularity=0.5), m(1, "2024-01-01 20:00:00", popularity=0.7),
                            m(1, "2024-01-02 08:00:00", popularity=1.0)])
    fact = gold.fact_movie_popularity(raw, silver.silver_movie_details(bronze_df(spark, [])))
    assert [r.popularity for r in fact.orderBy("snapshot_date").collect()] == [0.7, 1.0]

"""The model graph: bronze -> silver -> gold as named DataFrames (G1's core).

Nothing runs here; each entry is a lazy plan.  ``jobs.build_catalog``
materialises them in dependency order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cinelake.plans import gold, silver
from cinelake.sources import bronze, testbed

# Model -> the key that its written form is bucketed by: what it is joined and tested on.  Credits are
# tested on all columns of their key and joined on none, so they lie as their last grouping left them.
# The genre tables are as small as the genre vocabulary and are left as they are.
_CAST, _CREW = ("movie_id", "person_id"), ("movie_id", "person_id", "job")
BUCKET_KEYS = {
    "silver_movie": ("movie_id",), "silver_movie_details": ("movie_id",), "silver_bridge_movie_genre": ("movie_id",),
    "silver_movie_cast": _CAST, "silver_movie_crew": _CREW,
    "dim_movie": ("movie_id",), "dim_person": ("person_id",), "bridge_movie_genre": ("movie_id",),
    "bridge_movie_cast": _CAST, "bridge_movie_crew": _CREW,
}
# Model -> layer, in dependency order (fixed).
MODEL_LAYERS = {
    "silver_genre": "silver", "silver_movie": "silver", "silver_movie_details": "silver",
    "silver_bridge_movie_genre": "silver", "silver_movie_cast": "silver", "silver_movie_crew": "silver",
    "dim_genre": "gold", "dim_movie": "gold", "dim_person": "gold", "bridge_movie_genre": "gold",
    "bridge_movie_cast": "gold", "bridge_movie_crew": "gold", "fct_movies_by_genre": "gold",
}


class Bronze:
    """The four bronze tables; each is built on first access only, so a query
    that needs one table does not plan the other three."""

    def __init__(self, genre=None, movie=None, details=None, credits=None, factory=None):
        self._given = {"genre": genre, "movie": movie, "details": details, "credits": credits}
        self._factory = factory or {}

    def _get(self, name: str) -> DataFrame:
        if self._given[name] is None:
            self._given[name] = self._factory[name]()
        return self._given[name]

    genre = property(lambda self: self._get("genre"))
    movie = property(lambda self: self._get("movie"))
    details = property(lambda self: self._get("details"))
    credits = property(lambda self: self._get("credits"))


def testbed_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    """Bronze tables derived from the driver tables (FIXTURES.md section 3)."""
    return Bronze(factory={
        "genre": lambda: bronze.land_genre_rows(testbed.genre_landing(spark, sf_dir)),
        "movie": lambda: testbed.movie_raw(spark, sf_dir),
        "details": lambda: bronze.land_detail_rows(testbed.details_landing(spark, sf_dir)),
        "credits": lambda: bronze.land_credit_rows(testbed.credits_landing(spark, sf_dir)),
    })


SILVER_BUILDERS = {
    "silver_genre": lambda b: silver.silver_genre(b.genre),
    "silver_movie": lambda b: silver.silver_movie(b.movie),
    "silver_movie_details": lambda b: silver.silver_movie_details(b.details),
    "silver_bridge_movie_genre": lambda b: silver.silver_bridge_movie_genre(b.movie),
    "silver_movie_cast": lambda b: silver.silver_movie_cast(b.credits),
    "silver_movie_crew": lambda b: silver.silver_movie_crew(b.credits),
}
# Gold model -> (function, models it reads).
GOLD = {
    "dim_genre": (gold.dim_genre, ("silver_genre",)),
    "dim_movie": (gold.dim_movie, ("silver_movie", "silver_movie_details")),
    "dim_person": (gold.dim_person, ("silver_movie_cast", "silver_movie_crew")),
    "bridge_movie_genre": (gold.bridge_movie_genre, ("silver_bridge_movie_genre",)),
    "bridge_movie_cast": (gold.bridge_movie_cast, ("silver_movie_cast",)),
    "bridge_movie_crew": (gold.bridge_movie_crew, ("silver_movie_crew",)),
    "fct_movies_by_genre": (gold.fct_movies_by_genre, ("dim_genre", "bridge_movie_genre")),
}
GOLD_BUILDERS = {n: lambda m, f=f, inputs=inputs: f(*(m[i] for i in inputs)) for n, (f, inputs) in GOLD.items()}


def silver_inputs(name: str) -> set[str]:
    """The silver models that a model rests on, itself included if it is one."""
    return {name} if name in SILVER_BUILDERS else set().union(*(silver_inputs(i) for i in GOLD[name][1]))


def gold_inputs(names) -> list[str]:
    """The gold models among ``names`` and those they rest on, in dependency order."""
    need = {n for n in names if n in GOLD}
    for n in reversed(list(GOLD)):
        if n in need:
            need |= {i for i in GOLD[n][1] if i in GOLD}
    return [n for n in GOLD if n in need]


class Models(Mapping):
    """Lazy name -> DataFrame mapping over the model graph.

    ``silver`` may hold already-built (e.g. written and re-read) silver
    tables; otherwise they are planned from ``bronze`` on first use."""

    def __init__(self, bronze_tables: Bronze | None = None, silver_tables: Mapping[str, DataFrame] | None = None,
                 names=None):
        self._b = bronze_tables
        self._cache: dict[str, DataFrame] = dict(silver_tables or {})
        self._names = list(names or MODEL_LAYERS)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in SILVER_BUILDERS:
                self._cache[name] = SILVER_BUILDERS[name](self._b)
            elif name in GOLD_BUILDERS:
                self._cache[name] = GOLD_BUILDERS[name](self)
            else:
                raise KeyError(name)
        return self._cache[name]

    def __contains__(self, name) -> bool:
        return name in self._names

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def silver_models(b: Bronze) -> Models:
    return Models(b, names=list(SILVER_BUILDERS))


def gold_models(s: Mapping[str, DataFrame], names=None) -> Models:
    return Models(silver_tables=s, names=list(GOLD_BUILDERS) if names is None else names)


def all_models(b: Bronze) -> Models:
    return Models(b)

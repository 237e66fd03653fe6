"""Latest row per key -- SURVEY C7-C9 and B5.

The warehouse writes ``QUALIFY row_number() OVER (PARTITION BY k ORDER BY
ingested_at DESC) = 1``.  Here it is an aggregate, ``max(struct(order...,
payload...))``, with a partial (map-side) step: a key holding a third of all
rows is reduced inside every map task before the shuffle instead of being
sorted whole in one task as a window would.  A payload with strings makes
Spark plan it as a *sort* aggregate on both sides, so the map tasks sort
their whole rows: with about one row per key the partial step saves nothing
(README, "Latest row per key", has both forms measured at 1, 3 and 30 rows
per key).

Ties on ``ingested_at`` are arbitrary in the warehouse.  Here they are broken
deterministically: optional ascending numeric columns (array position) next,
then the greatest payload tuple, field by field, with NULL lowest.  Rows that
tie on everything are identical in the output, so the result is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LATEST = "__latest"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str = "ingested_at",
                   first: Sequence[str] = (), payload: Sequence[str] | None = None,
                   drop: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: greatest ``newest``; ties -> smallest ``first``
    (numeric), then greatest ``payload`` tuple (NULL lowest).

    ``drop`` names ordering-only columns left out of the result.  Output
    columns keep the input order.
    """
    keys, first, drop = list(keys), list(first), set(drop)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c != newest and c not in first]
    fields = [F.col(newest).alias("__o_newest")]
    fields += [(-F.col(c)).alias(f"__o_first{i}") for i, c in enumerate(first)]
    fields += [F.col(c) for c in payload]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias(_LATEST))
    out = []
    for c in df.columns:
        if c in drop:
            continue
        if c in keys:
            out.append(F.col(c))
        elif c == newest:
            out.append(F.col(f"{_LATEST}.__o_newest").alias(c))
        elif c in first:
            out.append((-F.col(f"{_LATEST}.__o_first{first.index(c)}")).alias(c))
        elif c in payload:
            out.append(F.col(f"{_LATEST}.{c}").alias(c))
    return agg.select(*out)


def latest_key_list(df: DataFrame, key: str) -> DataFrame:
    """Ids of the latest row per id.  Only the id is returned, which is
    exactly ``SELECT DISTINCT id`` (an aggregate without payload: hashed, partial + final)."""
    return df.select(key).distinct()

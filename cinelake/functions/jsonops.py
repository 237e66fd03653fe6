"""Typed access to semi-structured (VARIANT) values -- SURVEY C1-C6, A5.

All helpers return Column expressions, so they stay inside whole-stage
codegen and the variant paths can be pushed into the scan.

Semantics kept from the warehouse dialect:
* missing path or JSON null -> NULL;
* a value of the wrong type raises (strict ``variant_get``);
* integers are rounded half up, not truncated (``2.5::INTEGER`` is 3);
* flatten of an empty, null, missing or scalar value yields no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def _path(path: str) -> str:
    return path if path.startswith("$") else f"$.{path}"


def json_string(v, path: str) -> Column:
    return F.variant_get(_c(v), _path(path), "string")


def json_double(v, path: str) -> Column:
    return F.variant_get(_c(v), _path(path), "double")


def json_bool(v, path: str) -> Column:
    return F.variant_get(_c(v), _path(path), "boolean")


def json_bigint(v, path: str) -> Column:
    """``raw:path::INTEGER``: round half up through an exact decimal."""
    return F.round(F.variant_get(_c(v), _path(path), "decimal(38,9)"), 0).cast("bigint")


def blank_to_null(c: Column) -> Column:
    """``NULLIF(x, '')`` -- C2.

    Written as CASE WHEN: ``nullif`` plans as a common-expression projection,
    which hides the other variant paths of the same select from the Parquet
    scan; this form keeps every ``raw:path`` pushable into the shredded scan.
    """
    return F.when(c == F.lit(""), F.lit(None)).otherwise(c)


def json_date(v, path: str) -> Column:
    """``NULLIF(raw:path::VARCHAR, '')::DATE`` -- C3 (a bare ``cast('' as date)`` raises)."""
    return blank_to_null(json_string(v, path)).cast("date")


def json_array(v, path: str) -> Column:
    """The array at ``path`` as ``array<variant>``; NULL when absent, null or not an array.

    Exploding NULL yields no rows, which is the inner-flatten behaviour (C4/C5).
    """
    return F.try_variant_get(_c(v), _path(path), "array<variant>")


def required_array(v, path: str) -> Column:
    """``json_array`` that raises when something else than an array or null stands at ``path``."""
    found, value = json_array(v, path), F.variant_get(_c(v), _path(path), "variant")
    other = value.isNotNull() & ~F.is_variant_null(value)  # looked at only where no array was found
    return F.coalesce(found, F.when(other, F.raise_error(F.lit(f"not an array: {path}")).cast("array<variant>")))


# The flatten helpers read the array in a projection right above the scan and explode it only
# then, so the Parquet scan returns the paths in use from the shredded VARIANT, not whole documents.
def flatten_scalar_array(df: DataFrame, v: str, path: str, out: str, *keep) -> DataFrame:
    """C4: one row per element of an array of numbers, as a rounded bigint ``out``; ``keep`` are carried columns."""
    arrays = df.select(*keep, json_array(v, path).alias("__a"))
    flat = arrays.select(*arrays.columns[:-1], F.explode("__a").alias("__e"))
    return flat.select(*flat.columns[:-1], F.round(F.col("__e").cast("decimal(38,9)"), 0).cast("bigint").alias(out))


def flatten_struct_array(df: DataFrame, v: str, path: str, *keep) -> DataFrame:
    """One row per element of an array of objects: the carried columns, ``pos`` and the element ``e``."""
    arrays = df.select(*keep, json_array(v, path).alias("__a"))
    return arrays.select(*arrays.columns[:-1], F.posexplode("__a").alias("pos", "e"))


def flatten_match_row(df: DataFrame, v: str, path: str, id_path: str, key: str, *keep) -> DataFrame:
    """The elements ``e`` whose id equals the row's own ``key`` column."""
    arrays = df.select(key, *keep, json_array(v, path).alias("__a"))
    flat = arrays.select(*arrays.columns[:-1], F.explode("__a").alias("e"))
    return flat.where(json_bigint("e", id_path) == F.col(key))

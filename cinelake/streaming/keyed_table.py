"""A table with one row per key that batches are merged into -- SURVEY G5.

Layout under the table's root::

    data/version=V/bucket=B/     the rows of bucket B as version V left them
    versions/V.json              which version each bucket stands at, and the last batch of each stream

A key belongs to bucket ``pmod(xxhash64(key), buckets)``.  Merging a batch reads and rewrites only
the buckets that hold one of its keys; all others stay as they are and the new version points at
them.  A version exists once its JSON file does, which is written aside and renamed: readers see
a whole version or the one before.  The file also carries (stream, batch id), so a batch that the
stream replays after a crash is known and not merged again; what a crash left of an uncommitted
version is overwritten by the replay.

One writer at a time (a stream's checkpoint has one); a second one is refused when it finds its
version taken.  Buckets, not rows, reach the driver: a few bytes each.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cinelake.operators.dedupe import latest_per_key
from cinelake.session import scratch_dir

BUCKETS = 64
_BUCKET = "__bucket"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first (a listing)."""
    fs, p = _path(spark, f"{root}/versions")
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _state(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    found = versions(spark, root)
    if not found:
        return None
    return json.loads(_read_text(spark, f"{root}/versions/{found[-1] if version is None else version}.json"))


def _commit(spark: SparkSession, root: str, state: dict) -> None:
    fs, aside = _path(spark, f"{root}/versions/.{state['version']}.tmp")
    target = _path(spark, f"{root}/versions/{state['version']}.json")[1]
    if fs.exists(target):
        raise RuntimeError(f"version {state['version']} of {root} is there: the table has another writer")
    out = fs.create(aside, True)
    out.write(json.dumps(state).encode("utf-8"))
    out.close()
    if not fs.rename(aside, target):
        raise RuntimeError(f"version {state['version']} of {root} could not be committed")


def _rows(spark: SparkSession, root: str, state: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of the named buckets (all by default) as a version has them; no other file is opened."""
    schema = StructType.fromJson(state["schema"])
    at = {int(b): v for b, v in state["at"].items() if buckets is None or int(b) in set(buckets)}
    if not at:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/data/version={v}/bucket={b}" for b, v in sorted(at.items())])


def _write(rows: DataFrame, root: str, version: int) -> None:
    """One file a bucket; ``rows`` carry their bucket."""
    rows.withColumnRenamed(_BUCKET, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/version={version}")


def _bucketed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def merge_batch(rows: DataFrame, root: str, keys: Sequence[str], newest: str, stream: str, batch: int, buckets: int = BUCKETS) -> bool:
    """Merge a batch: per key the row with the greatest ``newest`` (ties as in ``latest_per_key``) of the batch and the table.

    False if this stream's batch is in the table.  ``buckets`` counts for a new table only.  A
    batch without rows is committed without a new file.
    """
    spark, keys = rows.sparkSession, list(keys)
    state = _state(spark, root) or {"version": -1, "buckets": buckets, "schema": json.loads(rows.schema.json()), "at": {}, "streams": {}}
    if state["streams"].get(stream, -1) >= batch:
        return False
    version, columns = state["version"] + 1, [f["name"] for f in state["schema"]["fields"]]
    scratch = scratch_dir(spark, "upsert-batch")
    # reduced before anything else: a key that fills the batch is one row from here on
    _bucketed(latest_per_key(rows.select(*columns), keys, newest), keys, state["buckets"]).write.parquet(scratch)
    fresh = spark.read.parquet(scratch)
    touched = sorted(r[0] for r in fresh.select(_BUCKET).distinct().collect())
    if touched:
        stored = _bucketed(_rows(spark, root, state, touched), keys, state["buckets"])
        both = stored.unionByName(fresh).repartition(_BUCKET)   # clusters the keys too: the only shuffle
        merged = latest_per_key(both, [_BUCKET, *keys], newest)
        _write(merged.select(_BUCKET, *columns), root, version)
    _commit(spark, root, state | {"version": version, "at": state["at"] | {str(b): version for b in touched},
                                  "streams": state["streams"] | {stream: batch}})
    fs, p = _path(spark, scratch)
    fs.delete(p, True)
    return True


def read_latest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its newest (or the named) version."""
    state = _state(spark, root, version)
    if state is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return _rows(spark, root, state)


def touched_buckets(spark: SparkSession, root: str, version: int) -> set[int]:
    """The buckets that a version rewrote."""
    return {int(b) for b, v in _state(spark, root, version)["at"].items() if v == version}


def rebucket(spark: SparkSession, root: str, keys: Sequence[str], buckets: int) -> int:
    """Write the whole table as a new version with another number of buckets (when buckets have grown large)."""
    state = _state(spark, root)
    if state is None:
        raise FileNotFoundError(f"no committed version under {root}")
    version = state["version"] + 1
    rows = _bucketed(_rows(spark, root, state), list(keys), buckets).repartition(_BUCKET)
    _write(rows, root, version)
    fs, p = _path(spark, f"{root}/data/version={version}")
    filled = [st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(p) if st.getPath().getName().startswith("bucket=")]
    _commit(spark, root, state | {"version": version, "buckets": buckets, "at": {b: version for b in filled}})
    return version


def remove_unused(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete bucket folders that none of the newest ``keep`` versions points at, and older version files; returns the folders."""
    found = versions(spark, root)
    kept = found[-keep:]
    used = {(int(v), int(b)) for k in kept for b, v in _state(spark, root, k)["at"].items()}
    deleted = []
    fs, data = _path(spark, f"{root}/data")
    for folder in (fs.listStatus(data) if fs.exists(data) else []):
        version = int(folder.getPath().getName().split("=", 1)[1])
        if version > kept[-1]:
            continue                     # a merge that has not been committed yet
        for st in fs.listStatus(folder.getPath()):
            name = st.getPath().getName()
            if name.startswith("bucket=") and (version, int(name.split("=", 1)[1])) not in used:
                fs.delete(st.getPath(), True)
                deleted.append(st.getPath().toString())
    for v in found[:-keep]:
        fs.delete(_path(spark, f"{root}/versions/{v}.json")[1], False)
    return deleted

"""Jobs: materialisation, layer routing and the pipelines -- SURVEY A10-A12, G1-G3 (and A14, B10, B11 as a job).

Tables are written as Parquet under ``<root>/<layer>/<table>`` (the schema
name is exactly the layer).  A rebuild writes a new ``version=N`` folder and
readers take the newest complete one, so a failed or replayed rebuild never
exposes a half-written table.  Downstream models read the written tables,
which also cuts the lineage between layers.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators import quality, worklist
from cinelake.plans import catalog, search_index, silver
from cinelake.session import scratch_dir
from cinelake.sources import bronze
from cinelake.sources.landing import parse_landing, read_landing, read_lines, request_day

LAYERS = ("bronze", "silver", "gold")


def table_path(root: str, layer: str, table: str) -> str:
    """The schema of a model is exactly its layer name (no prefix)."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current_version(spark: SparkSession, table_root: str) -> str | None:
    """Newest complete ``version=N`` folder of a table (metadata listing only)."""
    fs, p = _fs(spark, table_root)
    if not fs.exists(p):
        return None
    best = None
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version="):
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                v = int(name.split("=", 1)[1])
                best = v if best is None or v > best else best
    return None if best is None else f"{table_root}/version={best}"


_LAYOUT = "_bucketing"     # beside the data files of a bucketed version; readers of plain Parquet pass over it


def materialize_table(df: DataFrame, root: str, layer: str, table: str, version: int | None = None) -> str:
    """A10: full rebuild -- write a new version, then it becomes current.

    ``version`` defaults to the wall clock in ms; a replay with the same
    version overwrites only its own folder (idempotent).

    A model with a key in ``catalog.BUCKET_KEYS`` is written bucketed and sorted by it, into as
    many buckets as a shuffle has partitions.  A model that was grouped or joined on that key is
    written as it stands (Catalyst leaves the repartition out); joins, groupings and data tests on
    the key of two such tables then need no exchange.
    """
    spark = df.sparkSession
    v = version if version is not None else int(time.time() * 1000)
    path = f"{table_path(root, layer, table)}/version={v}"
    key = catalog.BUCKET_KEYS.get(table)
    if key is None:
        df.write.mode("overwrite").parquet(path)
        return path
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"cinelake_{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    (df.repartition(buckets, *key).write.mode("overwrite").format("parquet").bucketBy(buckets, *key).sortBy(*key)
       .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")      # the catalogue entry only; the files are external
    fs, p = _fs(spark, f"{path}/{_LAYOUT}")
    out = fs.create(p, True)
    out.write(json.dumps({"key": key, "buckets": buckets}).encode())
    out.close()
    return path


def _table_name(path: str) -> str:
    return f"cinelake_{hashlib.md5(path.encode()).hexdigest()}"


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """One written version of a table; if it is bucketed, as a catalogue table over its files, so that Spark knows the buckets."""
    fs, p = _fs(spark, f"{path}/{_LAYOUT}")
    plain = spark.read.parquet(path)
    if not fs.exists(p):
        return plain
    stream = fs.open(p)
    try:
        layout = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
        key = layout["key"] if isinstance(layout["key"], list) else [layout["key"]]      # a single name in versions written before
        by = ", ".join(f"`{c}`" for c in key)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_table(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    path = current_version(spark, table_path(root, layer, table))
    if path is None:
        raise FileNotFoundError(f"{layer}.{table} has no complete version under {root}")
    return read_version(spark, path)


def ordered_scan(df: DataFrame, column: str) -> DataFrame:
    """``SELECT * ... ORDER BY column``."""
    return df.orderBy(column)


def count_rows(df: DataFrame) -> DataFrame:
    """``COUNT(1)``."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete every silver and gold version but the newest ``keep`` complete ones
    (and failed attempts older than those); returns the deleted folders.  Call it
    while no reader still uses an older version."""
    deleted = []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name, layer in catalog.MODEL_LAYERS.items():
        fs, p = _fs(spark, table_path(root, layer, name))
        if not fs.exists(p):
            continue
        found = {int(st.getPath().getName().split("=", 1)[1]): st.getPath() for st in fs.listStatus(p)
                 if st.getPath().getName().startswith("version=")}
        complete = sorted((v for v, f in found.items() if fs.exists(path(f, "_SUCCESS"))), reverse=True)[:keep]
        for v, folder in found.items():
            if complete and v < complete[-1]:
                fs.delete(folder, True)
                deleted.append(folder.toString())
    return deleted


MODEL_THREADS = 4   # models of one layer built concurrently (the reference's model threads)


class BuildFailed(RuntimeError):
    """A model failed.  ``report`` is the full quality report with one row per failed or skipped model."""

    def __init__(self, problems: list[tuple[str, str, str]], report: DataFrame):
        super().__init__("; ".join(f"{name} {what}: {why}" for name, what, why in problems))
        self.problems, self.report = problems, report


def _materialize(graph: dict[str, tuple[set[str], object]], threads: int) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Run name -> (the names it needs, what to do), each as soon as what it needs is done, ``threads`` at a time.

    Returns name -> error for what failed and name -> failed names for what was left out because of them."""
    from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

    failed: dict[str, str] = {}
    skipped: dict[str, list[str]] = {}
    done: set[str] = set()
    waiting, running = dict(graph), {}
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        while waiting or running:
            for name in list(waiting):
                needs, act = waiting[name]
                if bad := sorted(needs & set(failed)) + sorted({x for n in needs & set(skipped) for x in skipped[n]}):
                    skipped[name] = sorted(set(bad))
                elif needs <= done:
                    running[pool.submit(act)] = name
                else:
                    continue
                del waiting[name]
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                try:
                    future.result()
                    done.add(name)
                except Exception as e:  # noqa: BLE001 -- collected, tests still run, then raised as BuildFailed
                    failed[name] = str(e)
    return failed, skipped


def materialize_all(graph: dict[str, tuple[set[str], object]], threads: int = MODEL_THREADS) -> None:
    """Run such a graph whole; after an error nothing more is started, and the error is raised as it came."""
    errors: list[Exception] = []

    def kept(act):
        def run():
            if errors:
                return
            try:
                act()
            except Exception as e:
                errors.append(e)
                raise
        return run

    _materialize({n: (needs, kept(act)) for n, (needs, act) in graph.items()}, threads)
    if errors:
        raise errors[0]


def build_catalog(spark: SparkSession, b: catalog.Bronze, root: str, version: int | None = None,
                  threads: int = MODEL_THREADS, indexes: bool = False) -> DataFrame:
    """G1: every model once the models it reads are written, from their tables of this very version, then every data test.

    A failed model takes the models that rest on it out of the build; their
    older versions stay current, and the tests run on what is current.
    Failed and skipped models are rows of the report (``failures`` 1), and the
    job ends with ``BuildFailed``, which carries that report.  With
    ``indexes`` the discovery indexes are written too, each after its model.
    """
    v = version if version is not None else int(time.time() * 1000)

    def written(name):
        return read_version(spark, f"{table_path(root, catalog.MODEL_LAYERS[name], name)}/version={v}")

    silver_plans = catalog.silver_models(b)

    def make(name):
        if name in catalog.SILVER_BUILDERS:
            plan = silver_plans[name]
        else:
            build, inputs = catalog.GOLD[name]
            plan = build(*(written(i) for i in inputs))
        materialize_table(plan, root, catalog.MODEL_LAYERS[name], name, v)

    graph = {n: (set() if n in catalog.SILVER_BUILDERS else set(catalog.GOLD[n][1]), lambda n=n: make(n)) for n in catalog.MODEL_LAYERS}
    if indexes:
        graph |= {n: ({model}, lambda n=n, model=model, write=write: write(written(model), search_index.index_path(root, n, v)))
                  for n, (model, write) in search_index.INDEXES.items()}
    failed, skipped = _materialize(graph, threads)
    tables = {}
    for n, layer in catalog.MODEL_LAYERS.items():
        if n not in failed and n not in skipped:
            tables[n] = written(n)
        elif current_version(spark, table_path(root, layer, n)):
            tables[n] = read_table(spark, root, layer, n)
    report = quality.quality_report(tables)
    problems = [(n, "build", why) for n, why in failed.items()] + [
        (n, "skipped", "needs " + ", ".join(inputs)) for n, inputs in skipped.items()]
    if problems:
        rows = spark.createDataFrame([(*p, 1) for p in problems],
                                     "table_name string, test_name string, column_names string, failures bigint")
        raise BuildFailed(problems, report.unionByName(rows))
    return report


def _bronze_root(root: str, table: str) -> str:
    return table_path(root, "bronze", table)


# Partition columns of the bronze tables that are loaded run by run.
_PARTS = {"genre_raw": ("run_id",), "movie_raw": ("run_id", "month")}


def read_bronze(spark: SparkSession, root: str) -> catalog.Bronze:
    """The four bronze tables; one that was never loaded is empty (``CREATE TABLE IF NOT EXISTS``)."""
    def rd(t):
        key = bronze.BRONZE_TABLES[t]
        fs, p = _fs(spark, _bronze_root(root, t))
        schema = f"{key} bigint, endpoint string, raw_json variant, ingested_at timestamp_ntz"
        if not fs.exists(p):
            return spark.createDataFrame([], schema)
        return spark.read.parquet(_bronze_root(root, t)).select(key, "endpoint", "raw_json", "ingested_at")
    return catalog.Bronze(genre=rd("genre_raw"), movie=rd("movie_raw"),
                          details=rd("movie_details_raw"), credits=rd("movie_credits_raw"))


def _folders(spark: SparkSession, path: str, prefix: str) -> set[str]:
    """Values of the partition folders ``<prefix>=...`` right under ``path`` (a listing)."""
    from urllib.parse import unquote

    fs, p = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return {unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{prefix}=")}


def _marks(root: str, table: str) -> str:
    return f"{table_path(root, 'bronze', '_loaded')}/{table}"


def new_runs(spark: SparkSession, landing: str, root: str, table: str) -> list[str]:
    """Landed fetch runs that ``table`` has not taken in (two listings; one name per run)."""
    return sorted(_folders(spark, landing, "run_id") - _folders(spark, _marks(root, table), "run_id"))


def _mark(spark: SparkSession, root: str, table: str, runs: list[str]) -> None:
    from urllib.parse import quote

    for run in runs:
        fs, p = _fs(spark, f"{_marks(root, table)}/run_id={quote(run, safe='')}")
        fs.mkdirs(p)


def _ledger(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A small append-only table of what has been taken in; empty before its first entry."""
    path = _marks(root, name)
    fs, p = _fs(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(p) else spark.createDataFrame([], schema)


def _load(rows: DataFrame, root: str, table: str) -> None:
    """Write bronze rows by run (and month): a folder appears whole, and a repeated load writes the same folder again."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*_PARTS[table]).parquet(_bronze_root(root, table)))


_MONTHS = "run_id string, month date, pages bigint"
_RUNS = "run_id string, files bigint, bytes bigint"
_LEFT = "run_id string, movie_id bigint"


def _run_sizes(spark: SparkSession, landing: str, runs: set[str]) -> dict[str, tuple[int, int]]:
    """Files and bytes of every run folder (metadata only); they change when something lands in a run again."""
    from urllib.parse import quote

    out = {}
    for run in sorted(runs):
        fs, p = _fs(spark, f"{landing}/run_id={quote(run, safe='')}")
        if fs.exists(p):
            summary = fs.getContentSummary(p)
            out[run] = (summary.getFileCount(), summary.getLength())
    return out


def open_runs(spark: SparkSession, landing: str, root: str) -> dict[str, tuple[int, int]]:
    """Discover runs with something in them that bronze may not have: new ones, ones of which only some
    months were asked for, and ones in which more has landed since.  Names and sizes only."""
    sizes = _run_sizes(spark, landing, _folders(spark, landing, "run_id"))
    seen = {tuple(r) for r in _ledger(spark, root, "movie_raw_runs", _RUNS).collect()}    # one row a run, or a few
    return {run: size for run, size in sizes.items() if (run, *size) not in seen}


def load_movies(spark: SparkSession, landing: str, root: str, run_month: str | None = None) -> DataFrame | None:
    """Accepted discover pages -> bronze, one folder per (run, month); returns the pairs loaded, None if no run is open.

    The ledger holds (run, month, pages landed).  A pair is loaded when the ledger does not have it
    with as many pages as have landed, so a month whose late page arrives is judged and written
    again, whole.  ``run_month`` restricts the load to one month; the other months of its runs stay
    open for a later call.  The ledger is written after the rows: a crash between the two loads the
    same folders once more.
    """
    runs = open_runs(spark, landing, root)
    if not runs:
        return None
    lines = read_lines(spark, landing, list(runs))
    day = request_day()      # the body is not parsed here
    landed = lines.groupBy("run_id", day.alias("month")).agg(F.count(F.lit(1)).alias("pages"))
    if run_month is not None:
        landed = landed.where(F.col("month") == F.lit(run_month).cast("date"))
    todo = landed.join(_ledger(spark, root, "movie_raw_months", _MONTHS), ["run_id", "month", "pages"], "left_anti")
    path = scratch_dir(spark, "months-to-load")
    todo.write.parquet(path)
    todo = spark.read.schema(_MONTHS).parquet(path)
    wanted = lines.withColumn("month", day).join(todo.select("run_id", "month"), ["run_id", "month"], "left_semi").select("value", "run_id")
    _load(bronze.land_movie_rows(worklist.accept_pages(parse_landing(wanted), stored=True), carry=("run_id", "month")), root, "movie_raw")
    todo.write.mode("append").parquet(_marks(root, "movie_raw_months"))
    if run_month is None:
        whole = spark.createDataFrame([(run, *size) for run, size in runs.items()], _RUNS)
        whole.coalesce(1).write.mode("append").parquet(_marks(root, "movie_raw_runs"))
    return todo


def _append_worklist(spark: SparkSession, landing: str, root: str, table: str, todo: DataFrame, land) -> None:
    """Landed responses whose id is on the worklist -> bronze.  A repeated call finds those ids done.

    ``todo`` has movie_id and may have ``after``: only a response fetched later counts then.  Ids that
    a run has and nobody asked for yet are noted with their run, so that a run is opened again
    once one of them comes onto a worklist (its movie's month is loaded later, or the movie has changed).
    """
    runs = new_runs(spark, landing, root, table)
    left = _ledger(spark, root, f"{table}_left", _LEFT)
    reopened = [r[0] for r in left.join(todo.select("movie_id").distinct(), "movie_id", "left_semi").select("run_id").distinct().collect()]   # run names
    if runs or reopened:
        on = todo.withColumnRenamed("movie_id", "request_key")
        responses = read_landing(spark, landing, sorted({*runs, *reopened}))
        if "after" in on.columns:
            fetched = responses.join(on, "request_key").where(F.col("fetched_at") > F.col("after")).drop(*[c for c in on.columns if c != "request_key"])
        else:
            fetched = responses.join(on, "request_key", "left_semi")
        bronze.bronze_append(land(fetched), _bronze_root(root, table))
    if runs:
        ids = read_landing(spark, landing, runs).select("run_id", F.col("request_key").alias("movie_id")).where("movie_id is not null")
        ids.distinct().join(todo.select("movie_id"), "movie_id", "left_anti").select("run_id", "movie_id").write.mode("append").parquet(_marks(root, f"{table}_left"))
    _mark(spark, root, table, runs)


def daily_increment(spark: SparkSession, landing_root: str, root: str, run_month: str | None = None,
                    version: int | None = None) -> DataFrame:
    """New genre runs, the months of discover runs that bronze lacks
    -> details worklist -> landed details -> details of changed movies again
    -> credits worklist -> landed credits -> G1.

    ``landing_root`` holds the landed responses (``genre/ discover/ details/
    credits/`` and, if changes are followed, ``changes/``; one ``run_id=...``
    folder per fetch run).  Only what bronze has not taken in is loaded, so a
    repeated call adds nothing.  With ``run_month`` only that month is
    loaded; the others stay open for the next call or for ``full_backfill``.
    The popularity days of what was loaded are brought up to date (``popularity_days``).
    Returns the G1 quality report.
    """
    from cinelake.plans import popularity_days

    land = {k: f"{landing_root}/{k}" for k in ("genre", "discover", "details", "credits", "changes")}
    runs = new_runs(spark, land["genre"], root, "genre_raw")
    if runs:
        _load(bronze.land_genre_rows(read_landing(spark, land["genre"], runs), carry=("run_id",)), root, "genre_raw")
        _mark(spark, root, "genre_raw", runs)
    load_movies(spark, land["discover"], root, run_month)
    popularity_days.refresh_popularity(spark, root)
    b = read_bronze(spark, root)
    _append_worklist(spark, land["details"], root, "movie_details_raw", worklist.details_worklist(b.movie, b.details),
                     bronze.land_detail_rows)
    if _folders(spark, land["changes"], "run_id"):
        refresh_changed(spark, landing_root, root)
    b = read_bronze(spark, root)
    _append_worklist(spark, land["credits"], root, "movie_credits_raw", worklist.credits_worklist(b.details, b.credits),
                     bronze.land_credit_rows)
    return build_catalog(spark, read_bronze(spark, root), root, version)


def full_backfill(spark: SparkSession, discover_landing: str, root: str) -> DataFrame:
    """Every landed month that bronze lacks at once (one distributed read
    instead of a serial month loop) -> accepted pages -> bronze movie rows,
    one folder per run and month -> silver_movie over that bronze.

    Also loads the months that daily runs left open, and months of which more
    pages have landed; a repeated call loads nothing."""
    load_movies(spark, discover_landing, root)
    return silver.silver_movie(read_bronze(spark, root).movie)


# ---- movies that changed (A14, B10, B11) -------------------------------------------------
_WINDOWS = "run_id string, window_start date, window_end date"
_CHANGES = "movie_id bigint, change_date date, run_id string"


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """The change lists taken in so far: (movie_id, change_date, run_id)."""
    fs, p = _fs(spark, _bronze_root(root, "movie_changes"))
    return spark.read.schema(_CHANGES).parquet(_bronze_root(root, "movie_changes")) if fs.exists(p) else spark.createDataFrame([], _CHANGES)


def change_windows(spark: SparkSession, root: str) -> DataFrame:
    """The windows whose change list has landed whole: (window_start, window_end)."""
    return _ledger(spark, root, "change_windows", _WINDOWS).select("window_start", "window_end").distinct()


def load_changes(spark: SparkSession, landing: str, root: str) -> None:
    """Change lists of runs in which something new has landed -> bronze, one folder a run; whole windows into the ledger.

    A window counts once all its pages are there; one that lacks a page stays a gap, is fetched
    again by another run, and its ids are taken meanwhile."""
    sizes = _run_sizes(spark, landing, _folders(spark, landing, "run_id"))
    seen = {tuple(r) for r in _ledger(spark, root, "change_runs", _RUNS).collect()}
    runs = {run: size for run, size in sizes.items() if (run, *size) not in seen}
    if not runs:
        return
    pages = read_landing(spark, landing, list(runs))
    rows = bronze.change_list_rows(pages, carry=("run_id",)).select("movie_id", "change_date", "run_id").distinct()
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(_bronze_root(root, "movie_changes"))
    worklist.whole_windows(pages).write.mode("append").parquet(_marks(root, "change_windows"))
    whole = spark.createDataFrame([(run, *size) for run, size in runs.items()], _RUNS)
    whole.coalesce(1).write.mode("append").parquet(_marks(root, "change_runs"))


def missing_changes(spark: SparkSession, root: str, since: str, until: str, days: int = worklist.BACKFILL_DAYS) -> DataFrame:
    """Windows of at most ``days`` days within [since, until] whose change lists are still to be fetched."""
    bounds = spark.range(1).select(F.lit(since).cast("date").alias("first"), F.lit(until).cast("date").alias("last"))
    return worklist.missing_windows(change_windows(spark, root), bounds, days)


def refresh_changed(spark: SparkSession, landing_root: str, root: str) -> DataFrame:
    """Take in new change lists, then the details of changed movies that were fetched again; returns the
    movies whose details are still older than their last change: (movie_id, last_changed, after).

    The newer response is appended; silver takes the newest, so it supersedes the old one."""
    load_changes(spark, f"{landing_root}/changes", root)
    stale = worklist.refresh_worklist(read_bronze(spark, root).details, read_changes(spark, root))
    path = scratch_dir(spark, "stale-details")
    stale.write.parquet(path)                                   # the list that is worked off must not move while bronze grows
    stale = spark.read.schema(stale.schema).parquet(path)
    _append_worklist(spark, f"{landing_root}/details", root, "movie_details_raw", stale, bronze.land_detail_rows)
    return worklist.refresh_worklist(read_bronze(spark, root).details, read_changes(spark, root))

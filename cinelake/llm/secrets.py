"""Secret scans (4) with multipart credential linking, in DataFrame functions only.

Strong candidates (assignments, access identifiers, long hex strings) are always reported.  Weak
ones (plain identifiers such as ``client_id=...``, unlabelled high-variety strings, endpoints)
mean nothing alone: they are reported only if a complementary part stands in the same scope, here
the document, with at most ``reach`` code points between the two.

Positions: a kind's matches and the gaps between them (``split`` by the same pattern) come from
one row; running sums over them give code point offsets.  The interval join is an equi-join on
(row, bin of ``reach`` code points): each bin is summarised by the first start and the last end of
a role's parts in it beforehand, so a candidate meets one row per role and bin that it reaches,
however many parts a scope holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.common import pick, written

REACH = 400
REDACTED = "[SECRET]"

# kind -> pattern, in the order in which equal starts are listed.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": _ASSIGN,
    # a run that is long enough, as runs that fall short are dropped anyway
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "endpoint": r"""(?i:https?|ftp|s3|amqps?|redis|mysql|mongodb|postgres|postgresql)://[^\s"'<>]+""",
    "identifier": r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}""",
    "opaque": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]{0,40}[0-9])[A-Za-z0-9+/_-]{24,}",
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
WEAK = KINDS[3:]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "endpoint": "endpoint", "identifier": "identifier", "opaque": "secret"}
# A weak candidate's role -> roles of which one must stand in reach.
NEEDS = {"identifier": ["secret"], "secret": ["identifier", "endpoint"], "endpoint": ["secret"]}

_CANDIDATE = "array<struct<kind:int,i:int,gap:int,match:string>>"


def _matches(text: Column, kind: str) -> Column:
    pattern = F.lit(PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    rows = F.transform(found, lambda m, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.char_length(F.get(gaps, i)).alias("gap"), m.alias("match")))
    return F.when(F.regexp_like(text, pattern), rows).otherwise(F.array().cast(_CANDIDATE))


def candidates(text: Column) -> Column:
    """All matches of all kinds in a text, each with its number and the gap before it."""
    return F.concat(*[_matches(text, k) for k in KINDS])


def spans(keyed: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of what is reported, from (row, found): one row per document and its ``candidates``."""
    flat = keyed.where(F.size("found") > 0).select("row", F.inline("found"))
    by_kind = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("match")
    end = F.sum(F.col("gap") + size).over(by_kind)
    assigned = F.regexp_extract("match", _ASSIGN, 1)
    placed = (flat.select("row", "kind", "match", (end - size).cast("bigint").alias("start"), end.cast("bigint").alias("end"))
              .where((F.col("kind") != 0) | (F.char_length(assigned) >= 8)).drop("match"))
    # a weak candidate that overlaps one of an earlier kind is the same text seen twice
    order = Window.partitionBy("row").orderBy("start", "kind", "end")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    clash = F.lit(False)
    for k in range(len(BASE), len(KINDS)):
        first = F.when(F.col("kind") < k, F.col("start")), F.when(F.col("kind") < k, F.col("end"))
        over = (F.coalesce(F.max(first[1]).over(before) > F.col("start"), F.lit(False))
                | F.coalesce(F.min(first[0]).over(after) < F.col("end"), F.lit(False)))
        clash = F.when(F.col("kind") == k, over).otherwise(clash)
    kept = written(placed.withColumn("clash", clash).where(~F.col("clash")).drop("clash"), "secret-spans")
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind") + 1)
    # a part stands in every bin that it reaches into; a weak one looks into the bins within ``reach`` of its two ends
    low, high = F.col("start") - reach, F.col("end") + reach
    parts = kept.withColumn("role", role)
    summary = (parts.withColumn("bin", F.explode(F.sequence(F.expr(f"start div {reach}"), F.expr(f"end div {reach}"))))
               .groupBy("row", "role", "bin").agg(F.min("start").alias("first"), F.max("end").alias("last")))
    weak = parts.where(F.col("kind") >= len(BASE))
    needs = F.lit(None).cast("array<string>")
    for r, others in NEEDS.items():
        needs = F.when(F.col("role") == r, F.array(*[F.lit(o) for o in others])).otherwise(needs)
    probes = (weak.select("row", "kind", "start", "end", F.explode(needs).alias("need"))
              .withColumn("bin", F.explode(F.sequence(F.expr(f"greatest(0, start - {reach}) div {reach}"), F.expr(f"(end + {reach}) div {reach}")))))
    near = (F.col("last") >= low) & (F.col("first") <= high)
    linked = (probes.join(summary.withColumnRenamed("role", "need"), ["row", "need", "bin"]).where(near)
              .select("row", "kind", "start", "end").distinct())
    return kept.where(F.col("kind") < len(BASE)).unionByName(linked)


def _gathered(found: DataFrame) -> DataFrame:
    """(row, spans): a document's spans by start, then kind."""
    named = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    return (found.withColumn("name", named).groupBy("row")
            .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "name"))).alias("s"))
            .select(F.col("row").alias("span_row"), F.transform("s", lambda x: F.struct(x["name"].alias("kind"), x["start"], x["end"])).alias("spans")))


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, spans (kind, start, end in code points, end exclusive), by start, then kind.

    Null and empty texts have no spans; null and repeated doc_ids are carried along, one result
    per row; an empty table gives no rows.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = written(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", candidates(F.col("text")).alias("found")), "secret-candidates")
    got = _gathered(spans(keyed.select("row", "found"), reach))
    return (keyed.select("row", "doc_id").join(got, F.col("row") == F.col("span_row"), "left")
            .select("doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")))


def redact(docs: DataFrame, reach: int = REACH, text_col: str = "text", mark: str = REDACTED,
           length_col: str | None = None) -> DataFrame:
    """``docs`` with every reported span of ``text_col`` replaced by ``mark`` (overlapping spans by one mark).

    ``length_col``, if named, is set to the new length in code points where a text changed.  Rows without any candidate pass untouched, nulls too; all columns stay as they are otherwise.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at = f"_c{names.index(text_col)}"
    # the only scan of the texts: the rows are written beside their candidates
    held = written(plain.withColumn("row", F.monotonically_increasing_id()).withColumn("found", candidates(F.col(at))), "secret-candidates")
    suspect = F.size("found") > 0
    found = spans(held.where(suspect).select("row", "found"), reach)
    order = Window.partitionBy("row").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = (found.withColumn("new", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
              .withColumn("run", F.sum("new").over(runs))
              .groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
              .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cut"))
              .withColumnRenamed("row", "cut_row"))
    n = F.size("cut")
    piece = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(
        F.col(at), (F.when(i > 0, F.get("cut", i - 1)["end"]).otherwise(0) + 1).cast("int"),
        (F.coalesce(F.get("cut", i)["start"], F.char_length(at).cast("bigint"))
         - F.when(i > 0, F.get("cut", i - 1)["end"]).otherwise(0)).cast("int")))
    clean = F.when(F.col("cut").isNull(), F.col(at)).otherwise(F.array_join(piece, mark))
    out = {c: F.col(c) for c in plain.columns} | {at: clean}
    if length_col is not None:
        c = f"_c{names.index(length_col)}"
        out[c] = F.when(F.col("cut").isNull(), F.col(c)).otherwise(F.char_length(clean).cast(plain.schema[c].dataType))
    changed = (held.where(suspect).join(merged, F.col("row") == F.col("cut_row"), "left")
               .select(*[value.alias(f"new{c}") for c, value in out.items()]))  # names of their own: an alias can hide a column in a lambda
    return held.where(~suspect).select(*plain.columns).union(changed).toDF(*names)


def joined(spans_col: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

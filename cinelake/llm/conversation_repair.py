"""Conversation structure repair (11): weighted CYK interval parsing of role sequences.

A well-formed conversation has the role initials ``(s?(ua)+)?``.  In Chomsky normal form the repair
grammar has one nonterminal [p, q] for each pair of states of that language (start, after s, after
u, after a): "the turns of this span, edited, lead from p to q", with the rules
[p, r] -> [p, q] [q, r].  A terminal is one turn: kept, given another role or deleted.  Insertion
closure: turns may be inserted on either side of a terminal, so [p, q] also covers what insertions
reach.  A cell holds the least (cost, audit); the audit is the string of the edits' initials.

Spans are combined bottom-up by length.  Each edit sequence of a span can be cut at every boundary of
it, so one cut of a span gives its whole cell; the chart needs the spans of lengths 1, 2, 4, ... only
(``tests/llm`` holds it against the chart over all spans and all cuts).  No two audits of equal cost
in a cell are prefixes of one another (they edit the same turns, and a further insertion costs), so the
least audit of a span is put together from least audits.

Turns are numbered on many tasks and stand in the chart as one letter (role initial and fault).  A
conversation is cut into blocks of ``BLOCK`` turns, each a cell matrix of its own, and the matrices
of a conversation are combined ``FAN`` at a time until one is left.  Texts meet the result in a join by turn
number, so no task needs a conversation whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import pick, written
from cinelake.operators.ranking import row_number_within

BLOCK = 4_096             # turns that one string of letters holds
FAN = 64                  # cell matrices combined at once
RESTORE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5   # costs: other role, deletion, insertion, a kept turn that is cut off
INITIALS = "sua"
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_FINE, _TRUNCATED, _MUST_GO = range(3)
_SHORT = 16               # spans whose cells are remembered

Cells = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cells, right: Cells) -> Cells:
    """[p, r] -> [p, q] [q, r], the least (cost, audit) of all q."""
    out: Cells = {}
    for (p, q), (cost, audit) in left.items():
        for r in range(4):
            other = right.get((q, r))
            if other is not None:
                found = (cost + other[0], audit + other[1])
                if (p, r) not in out or found < out[p, r]:
                    out[p, r] = found
    return out


def _inserted() -> Cells:
    """What insertions alone reach: user and assistant turns, empty."""
    none: Cells = {(p, p): (0, "") for p in range(4)}
    once = none | {(p, q): (INSERT, "I") for (p, initial), q in _NEXT.items() if initial != "s"}
    return combine(once, once)


def letter(initial: int, fault: int) -> str:
    """A turn as a letter; ``initial`` is its place in INITIALS, 3 for any other."""
    return chr(ord("A") + 3 * initial + fault)


@lru_cache(maxsize=None)  # twelve letters
def terminal(turn: str) -> Cells:
    """The cells of one turn, closed under insertion on both sides."""
    initial, fault = divmod(ord(turn) - ord("A"), 3)
    cells: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    if fault != _MUST_GO:
        extra = CUT_OFF if fault == _TRUNCATED else 0
        for (p, role), q in _NEXT.items():
            options = [(extra, "K")] if INITIALS[initial:initial + 1] == role else []
            options += [(RESTORE + extra, "R")] if role != "s" else []
            for found in options:
                if (p, q) not in cells or found < cells[p, q]:
                    cells[p, q] = found
    return combine(combine(_inserted(), cells), _inserted())


@lru_cache(maxsize=100_000)
def _short(turns: str) -> Cells:
    if len(turns) == 1:
        return terminal(turns)
    half = 1 << ((len(turns) - 1).bit_length() - 1)
    return combine(_short(turns[:half]), _short(turns[half:]))


def combine_all(cells: list[Cells]) -> Cells:
    """Neighbouring spans joined pair by pair until one is left; an empty list is the empty span."""
    while len(cells) > 1:
        cells = [combine(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else _inserted()


def parse(turns: str) -> Cells:
    """The cells of a string of letters."""
    return combine_all([_short(turns[i:i + _SHORT]) for i in range(0, len(turns), _SHORT)])


def cheapest(cells: Cells) -> tuple[int, str]:
    """The least (cost, audit) that leads from the start to a well-formed end."""
    return min(cells[_START, q] for q in (_START, _ASSISTANT) if (_START, q) in cells)


def illegal_pairs(turns: str) -> int:
    """Neighbours whose role initials are not su, ua or au."""
    at = [(ord(t) - ord("A")) // 3 for t in turns]
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(at, at[1:]))


_CELL = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.large_string())]))
_SPAN = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("cells", _CELL), ("illegal", pa.int64()), ("ends", pa.string())])
_SPAN_DDL = "conv string, block bigint, cells array<struct<p: int, q: int, cost: bigint, audit: string>>, illegal bigint, ends string"


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    flat = [[{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cells.items()] for _, _, cells, _, _ in rows]
    columns = [[r[0] for r in rows], [r[1] for r in rows], flat, [r[3] for r in rows], [r[4] for r in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPAN, strict=True)], schema=_SPAN)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield _spans([(conv, block, parse(turns), illegal_pairs(turns), turns[0] + turns[-1]) for conv, block, turns in zip(
                *(part.column(c).to_pylist() for c in ("conv", "block", "turns")), strict=True)])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            spans = row["spans"]
            cells = combine_all([{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in spans])
            illegal = sum(s["illegal"] for s in spans) + sum(illegal_pairs(a["ends"][1] + b["ends"][0]) for a, b in zip(spans, spans[1:]))
            yield _spans([(row["conv"], row["block"], cells, illegal, spans[0]["ends"][0] + spans[-1]["ends"][1])])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = [cheapest({(c["p"], c["q"]): (c["cost"], c["audit"]) for c in cells}) for cells in batch.column("cells").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("illegal"), pa.array([c for c, _ in best], pa.int64()),
                                          pa.array([a for _, a in best], pa.string())], names=["conv", "illegal", "cost", "audit"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits taken apart: the turn's number (null for an insertion), its place afterwards (null if deleted), the edit, a new role."""
    for batch in batches:
        for conv, audit in zip(batch.column("conv").to_pylist(), batch.column("audit").to_pylist(), strict=True):
            edit = np.frombuffer(audit.encode(), "S1")
            there, stays = edit != b"I", edit != b"D"
            n, place = np.cumsum(there), np.cumsum(stays)
            odd = place[-1] % 2 if len(edit) else 0  # an odd number of turns begins with the system's
            role = np.where((place + odd) % 2 == 1, "user", "assistant")
            for at in range(0, len(edit), 10_000):
                cut = slice(at, at + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(conv), len(edit[cut])), pa.array(n[cut], mask=~there[cut]), pa.array(place[cut], mask=~stays[cut]),
                     pa.array(edit[cut].astype(str)), pa.array(role[cut].astype(object), pa.string(), mask=~np.isin(edit[cut], (b"R", b"I")))],
                    names=["conv", "n", "place", "edit", "new_role"])


def repair(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           block: int = BLOCK, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(report, turns) of all conversations.

    ``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; one row for each id.
    ``turns``: conv_id, n, place, edit, turn, role, text; the turns as repaired (``place`` from 1) and the deleted ones (place null).

    Turns are taken in order of ``turn`` (null first), then role, then the hash of role and text;
    repeated rows are turns of their own (the later ones duplicates).  A null role or text is one
    space: such a role fits nowhere, such a text is blank.  Rows with a null id are one conversation.  An empty
    table has no conversations.
    """
    plain = pick(df, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    conv_id = F.col("conv_id").cast("bigint")
    rows = plain.select(conv_id.alias("conv_id"), F.coalesce(conv_id.cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("bigint"),
                        role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    shown = F.rtrim("text", F.lit(SPACE))
    facts = rows.withColumns({"digest": digest, "blank": shown == "", "truncated": ~F.substring(shown, -1, 1).isin(*ENDS)})
    numbered = written(row_number_within(written(facts, "repair-rows"), ["conv"], ["turn", "role", "digest", "row"], "n"), "repair-turns")

    # a row is no duplicate if it is the first of its role and text; joined by turn number, so that a hot text spreads
    firsts = numbered.groupBy("conv", "digest").agg(F.min("n").alias("n")).select("conv", "n", F.lit(True).alias("new"))
    judged = numbered.select("conv", "conv_id", "n", "turn", "role", "blank", "truncated").join(firsts, ["conv", "n"], "left")
    duplicate = ~F.col("blank") & F.col("new").isNull()
    cut_off = ~F.col("blank") & ~duplicate & F.col("truncated")
    initial = F.when(F.startswith("role", F.lit("s")), 0).when(F.startswith("role", F.lit("u")), 1).when(
        F.startswith("role", F.lit("a")), 2).otherwise(3)
    fault = F.when(F.col("blank") | duplicate, _MUST_GO).when(cut_off, _TRUNCATED).otherwise(_FINE)
    judged = written(judged.select("conv", "conv_id", "n", "turn", "blank", duplicate.alias("duplicate"), cut_off.alias("truncated"),
                                   F.chr(ord("A") + 3 * initial + fault).alias("letter")), "repair-judged")

    by_turn = judged.groupBy("conv", "conv_id", "turn").agg(*[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    counts = by_turn.groupBy("conv", "conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])

    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "letter"))), lambda x: x["letter"]), "")
    blocks = judged.groupBy("conv", F.floor((F.col("n") - 1) / block).alias("block")).agg(letters.alias("turns"))
    spans = written(blocks.mapInArrow(_parsed, _SPAN_DDL), "repair-spans")
    while (spans.agg(F.max("block")).first()[0] or 0) > 0:  # levels: the logarithm of the longest conversation
        grouped = spans.groupBy("conv", F.floor(F.col("block") / fan).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("block").alias("b"), "cells", "illegal", "ends"))).alias("spans"))
        spans = written(grouped.mapInArrow(_joined, _SPAN_DDL), "repair-spans")
    best = written(spans.mapInArrow(_chosen, "conv string, illegal bigint, cost bigint, audit string"), "repair-audits")
    report = counts.join(best, "conv").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = best.select("conv", "audit").mapInArrow(_edits, "conv string, n bigint, place bigint, edit string, new_role string")
    kept = numbered.select("conv", "n", "turn", "role", "text")
    done = edits.join(kept, ["conv", "n"], "left")
    turns = done.select(F.when(F.col("conv") != "", F.col("conv").cast("bigint")).alias("conv_id"), "n", "place", "edit", "turn",
                        F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return report, turns

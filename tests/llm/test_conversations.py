"""Conversation repair and the prefix trie against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from cinelake.llm import conversation_repair as cr
from cinelake.llm import prefix_trie as pt
from cinelake.llm import queries
from cinelake.llm.common import hashed_lines
from tests.conftest import SF_SMALL
from tests.llm import brute_conversations as brute

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TURN = st.tuples(st.sampled_from("suax"), st.sampled_from([0, 0, 0, 1, 2]))
AWKWARD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"), (1, 2, "assistant", "Hello!"), (1, None, "user", "early."),
    (2, None, None, None), (2, None, None, None), (3, 5, "user", ""), (4, 9, "tool", "x"), (5, -3, "user", "a\n\t"), (5, 7, "assistant", "b. \r\n"),
    (None, 1, "user", "Who?"), (None, 2, "assistant", "No one."), (20, 1, "", ""), (21, 1, "user", "é\U0001f600?"), (-7, 1, "user", "minus."),
    (6, 1, "user", "word. " * 50_000), (6, 2, "assistant", "word " * 50_000), (7, 1, "assistant", "A."), (7, 1, "user", "B."), (7, 1, "user", "B."),
]


def symbols(turns):
    return [(initial, fault == 2, fault == 1) for initial, fault in turns]


def letters(turns):
    return "".join(cr.letter("suax".index(initial), fault) for initial, fault in turns)


@settings(max_examples=60, deadline=None)
@given(st.lists(TURN, max_size=3))
def test_short_repairs_against_all_edits(turns):
    assert cr.cheapest(cr.parse(letters(turns))) == brute.cheapest_by_trying(symbols(turns)) == brute.cheapest_left_to_right(symbols(turns))


@settings(max_examples=150, deadline=None)
@given(st.lists(TURN, max_size=40))
def test_repairs_turn_by_turn(turns):
    assert cr.cheapest(cr.parse(letters(turns))) == brute.cheapest_left_to_right(symbols(turns))


@settings(max_examples=40, deadline=None)
@given(st.lists(TURN, min_size=1, max_size=12))
def test_one_cut_of_a_span_gives_its_whole_cell(turns):
    row = letters(turns)
    chart = {(i, i + 1): cr.terminal(row[i]) for i in range(len(row))}
    for length in range(2, len(row) + 1):           # the chart over all spans, every cut of each
        for i in range(len(row) - length + 1):
            cuts = [cr.combine(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            assert all(c == cuts[0] for c in cuts)
            chart[i, i + length] = cuts[0]
    assert chart[0, len(row)] == cr.parse(row)


def check_repair(spark, rows, **sizes):
    report, turns = cr.repair(spark.createDataFrame(rows, SCHEMA), **sizes)
    want = brute.repaired(rows)
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in report.collect()}
    assert got == {c: v[:-1] for c, v in want.items()}
    lines = {}
    for r in turns.where("place is not null").orderBy("place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {c: v[-1] for c, v in want.items() if v[-1]}


def test_repair_of_awkward_rows(spark):
    check_repair(spark, AWKWARD)


def test_a_long_conversation_in_small_blocks(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["yes.", "no", "", f"text {t}.", f"text {t}"]))
            for c, n in ((1, 700), (2, 90), (3, 1), (None, 40)) for t in range(n)]
    check_repair(spark, rows, block=8, fan=3)


def test_repair_query_and_extra_columns(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    want = brute.repaired(list(brute.damaged(rows)))
    none = (0, 0, 0, 0, 0, 0, "", [])
    got = {r.conv_id: tuple(r)[1:] for r in entry.queries()["op11_conversation_repair"](spark, SF_SMALL).collect()}
    assert got == {c: (*want.get(c, none)[:-1], brute.sha("\n".join(want.get(c, none)[-1]))) for c in {r[0] for r in rows}}


def test_damage_of_nulls(spark):
    got = sorted(map(str, (tuple(r) for r in queries.damaged(spark.createDataFrame(AWKWARD, SCHEMA)).collect())))
    assert got == sorted(map(str, brute.damaged(AWKWARD)))


def test_hashed_lines_of_large_and_null_keys(spark):
    rows = [(k, o, f"{k}-{o}") for k in (1, None, 3) for o in range(3000)]
    got = {r.key: r.digest for r in hashed_lines(spark.createDataFrame(rows, "key bigint, o bigint, line string"), "key", "o", "line", "digest").collect()}
    assert got == {k: brute.sha("\n".join(f"{k}-{o}" for o in range(3000))) for k in (1, None, 3)}


@pytest.mark.parametrize("shard_turns", [200_000, 15])
def test_trie_of_awkward_rows(spark, shard_turns):
    extra = [(c, t, "user", f"shared {t}.") for c in range(100, 130) for t in range(3)] + [(c, 3, "assistant", f"own {c}") for c in range(110, 120)]
    rows = AWKWARD + extra
    got = sorted((tuple(r) for r in pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_turns=shard_turns).collect()), key=str)
    assert got == brute.trie(rows)


@pytest.mark.parametrize("shard_turns", [200_000, 60])
def test_trie_query(spark, shard_turns, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    monkeypatch.setattr(pt.prefix_trie, "__defaults__", (*pt.prefix_trie.__defaults__[:-1], shard_turns))
    got = entry.queries()["op12_prefix_trie"](spark, SF_SMALL)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.trie(rows)


def test_ids_beyond_one_block_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(pt, "ID_BLOCK", 7)
    rows = [(c, 0, "user", "same") for c in range(-40, 90, 3)]
    got = sorted((tuple(r) for r in pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute.trie(rows)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.lists(st.integers(0, 6), max_size=6).map(tuple), min_size=1, max_size=40))
def test_double_array_holds_exactly_the_prefixes(paths):
    nodes = sorted({p[:d] for p in paths for d in range(1, len(p) + 1)}, key=lambda p: (len(p), p))
    number = {p: i + 1 for i, p in enumerate(nodes)} | {(): 0}
    array = pt.DoubleArray(np.array([number[p[:-1]] for p in nodes], np.int64), np.array([p[-1] for p in nodes], np.int64))
    for p in number:
        for symbol in range(7):
            child = int(array.step(array.slot_of[[number[p]]], np.array([symbol]))[0])
            assert child == (array.slot_of[number[(*p, symbol)]] if (*p, symbol) in number else -1)
    assert len(set(array.slot_of.tolist())) == len(number)


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    report, turns = cr.repair(none)
    assert report.count() == turns.count() == pt.prefix_trie(none).count() == 0
    names = ["n", "CONV", "letter", "place", "path", "node", "Turn2", "row", "words"]
    wide = spark.createDataFrame([(*r, *["x"] * len(names)) for r in AWKWARD], f"{SCHEMA}, " + ", ".join(f"{n} string" for n in names))
    assert cr.repair(wide)[0].count() == len({r[0] for r in AWKWARD})
    assert sorted((tuple(r) for r in pt.prefix_trie(wide).collect()), key=str) == brute.trie(AWKWARD)

"""Conversation prefix trie (12): double arrays per prefix shard, upper nodes merged globally.

1. Turns are numbered within their conversation on many tasks (``row_number_within``) and reduced to
   16 bytes of the SHA-256 of (role, text) and the number of words; texts go no further.
2. Every conversation is rebuilt: the first h turns of its base conversation, then its own.  Its
   path is one row (20 bytes a turn).
3. Equal paths become one row with the number of conversations, the smallest id and the hash of all
   ids: ids are joined per block of ``ID_BLOCK`` numbers, so a path that a third of the
   conversations share gives short strings, and those are hashed one after the other in a stream.
4. Different paths are range-partitioned in order into prefix shards of about ``SHARD_TURNS`` turns.
   A node is in more than one shard only if it is a common prefix of the last path of one shard and
   the first of the next; one row for each shard tells how deep that reaches.
5. In each shard the trie is packed into a double array over dense turn ids (``DoubleArray``) and
   walked by all paths at once, depth by depth; sums run from the leaves up.
6. Nodes in more than one shard (and the root) come out with partial sums.  These are added up
   globally, and each such node's own share is added to all nodes above it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.common import pick, written
from cinelake.operators.ranking import row_number_within

BASE_STEP = 20            # conversation c is rebuilt on conversation c - c % 20
MOST_HEAD = 4             # with its first crc32(c) % 4 turns
ID_BLOCK = 65_536         # ids that are joined to one string
SHARD_TURNS = 200_000     # turns of the paths of a shard, in the mean
TURN = 16                 # bytes that stand for a turn in a path
_WORDS = r"[^\x20\x09-\x0D]+"


class DoubleArray:
    """A trie over dense symbols: child s of node t is at BASE[t] + s if CHECK there is t; -1 is free.

    Built from sorted different paths in one go: nodes with several children are placed first, most
    children first, each at the first base whose slots are all free; then every only child takes the
    next free slot.  The root is slot 0.
    """

    def __init__(self, parents: np.ndarray, symbols: np.ndarray):
        """Nodes 1.. in an order in which a parent comes before its children; node 0 is the root."""
        n = len(parents) + 1
        symbols = symbols.astype(np.int64)
        self.slot_of = np.zeros(n, np.int64)
        by = np.lexsort((symbols, parents))
        owners, start, count = np.unique(parents[by], return_index=True, return_counts=True)
        top = int(symbols.max()) if len(symbols) else 0
        size = 2 * n + top + 2
        free = np.ones(size, bool)
        free[0] = False
        base = np.zeros(n, np.int64)
        low = 1  # no free slot before it
        for k in np.argsort(-count, kind="stable")[:int((count > 1).sum())]:
            kids = by[start[k]:start[k] + count[k]]
            s = symbols[kids]
            while not free[low]:
                low += 1
            at, found = low, -1
            while found < 0:
                window = at + np.flatnonzero(free[at:at + 256])
                if at + 256 + s[-1] - s[0] >= len(free):
                    free = np.concatenate([free, np.ones(len(free) + int(s[-1] - s[0]) + 256, bool)])
                fits = free[window[:, None] + (s - s[0])[None, :]].all(axis=1) if len(window) else np.zeros(0, bool)
                if fits.any():
                    found = int(window[fits.argmax()])
                at += 256
            base[owners[k]] = found - s[0]
            self.slot_of[kids + 1] = found + s - s[0]
            free[self.slot_of[kids + 1]] = False
        lone = np.flatnonzero(count == 1)
        kids = by[start[lone]]
        slots = np.flatnonzero(free)[:len(kids)]
        self.slot_of[kids + 1] = slots
        base[owners[lone]] = slots - symbols[kids]
        last = int(self.slot_of.max()) + 1
        self.base = np.zeros(last, np.int64)
        self.check = np.full(last, -1, np.int64)
        self.base[self.slot_of] = base
        self.check[self.slot_of[1:]] = self.slot_of[parents]

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Children of many nodes at once; -1 where there is none."""
        at = self.base[nodes] + symbols
        inside = (at >= 0) & (at < len(self.check))
        return np.where(inside & (self.check[np.where(inside, at, 0)] == nodes), at, -1)


def _turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, n, turn_hash, words): the turns of every conversation, numbered from 1."""
    plain = pick(df, conv_id=id_col, turn=turn_col, role=role_col, text=text_col)
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    facts = plain.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"),
        F.substring(F.sha2(named, 256), 1, 2 * TURN).alias("turn_hash"),
        F.regexp_count(text, F.lit(_WORDS)).cast("int").alias("words"), F.monotonically_increasing_id().alias("row"))
    # repeated rows are alike but for their place, which only makes the order a total one
    return row_number_within(written(facts, "trie-turns"), ["conv_id"], ["turn", "role", "turn_hash", "row"], "n").select(
        "conv_id", "n", "turn_hash", "words")


def paths(turns: DataFrame, head: Column) -> DataFrame:
    """(conv_id, path, words): rebuilt conversations; ``head`` is the number of turns taken from the base one."""
    base_id = F.col("conv_id") - F.col("conv_id") % BASE_STEP
    convs = turns.where(F.col("n") == 1).select("conv_id", base_id.alias("base_id"), head.alias("h"))
    heads = turns.where((F.col("n") < MOST_HEAD) & (F.col("conv_id") % BASE_STEP == 0)).select(
        F.col("conv_id").alias("base_id"), F.col("n").alias("at"), "turn_hash", "words")
    taken = convs.where("h > 0").join(heads, "base_id").where(F.col("at") <= F.col("h"))
    # own turns stay behind all of the base's, as at most MOST_HEAD - 1 of those are taken
    own = turns.where(F.col("n") > head).select("conv_id", (F.col("n") + MOST_HEAD).alias("at"), "turn_hash", "words")
    kept = taken.select("conv_id", "at", "turn_hash", "words").unionByName(own)
    grouped = kept.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "turn_hash", "words"))).alias("t"))
    found = convs.select("conv_id").join(grouped, "conv_id", "left")  # a conversation may end up without a turn
    return found.select(
        "conv_id", F.unhex(F.array_join(F.coalesce(F.transform("t", lambda t: t["turn_hash"]), F.array().cast("array<string>")), "")).alias("path"),
        F.coalesce(F.transform("t", lambda t: t["words"]), F.array().cast("array<int>")).alias("words"))


def _different(found: DataFrame) -> DataFrame:
    """(path, words, members, smallest, ends): one row for each different path."""
    block = F.floor(F.col("conv_id") / ID_BLOCK)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    blocks = found.groupBy(F.sha2("path", 256).alias("path_id"), block.alias("block")).agg(
        ids.alias("ids"), F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("smallest"),
        F.any_value("path").alias("path"), F.any_value("words").alias("words"))
    schema = pa.schema([("path", pa.binary()), ("words", pa.list_(pa.int32())), ("members", pa.int64()), ("smallest", pa.int64()), ("ends", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # path_id, path, words, members, smallest, digest
        for batch in batches:
            done = []
            for path_id, ids, members, smallest, path, words in zip(*(batch.column(c).to_pylist() for c in (
                    "path_id", "ids", "members", "smallest", "path", "words")), strict=True):
                if held is None or held[0] != path_id:
                    if held is not None:
                        done.append((*held[1:5], held[5].hexdigest()))
                    held = [path_id, path, words, members, smallest, hashlib.sha256(ids.encode())]
                else:  # blocks come in the order of their numbers
                    held[3] += members
                    held[5].update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)] if done else [pa.array([], f.type) for f in schema], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*held[1:5], held[5].hexdigest()), schema)], schema=schema)

    ordered = blocks.select("path_id", "block", "ids", "members", "smallest", "path", "words").repartition("path_id").sortWithinPartitions("path_id", "block")
    return ordered.mapInArrow(hashed, "path binary, words array<int>, members bigint, smallest bigint, ends string")


def _node_keys(path: bytes, depth: int) -> list[bytes]:
    """Keys of the prefixes of a path, from the root on."""
    keys, digest = [], hashlib.sha256()
    for d in range(depth + 1):
        keys.append(digest.copy().digest()[:TURN])
        digest.update(path[d * TURN:(d + 1) * TURN])
    return keys


NODES = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                   ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()), ("words", pa.int64()),
                   ("node", pa.binary()), ("parent", pa.binary()), ("above", pa.list_(pa.binary()))])
_NODES_DDL = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, "
              "words bigint, node binary, parent binary, above array<binary>")


def shard_nodes(shard: pa.Table) -> pa.Table:
    """The nodes of one shard.  Those that other shards have too carry ``node`` (their key) and sums over this shard alone:
    of the conversations, and of the subtrees that only this shard has; the others are final, but for a ``parent`` that is shared."""
    shard = shard.sort_by("path")
    raw, members = shard["path"].to_pylist(), shard["members"].to_numpy()
    smallest, ends = shard["smallest"].to_numpy(), shard["ends"].to_pylist()
    lengths = np.array([len(p) // TURN for p in raw])
    flat = np.frombuffer(b"".join(raw), dtype=f"V{TURN}")
    symbols, dense = np.unique(flat.view([("a", ">u8"), ("b", ">u8")]), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(lengths)])
    row = np.repeat(np.arange(len(raw)), lengths)
    depth = np.arange(len(flat)) - first[row]
    # a turn makes a node unless the path before it has the same turns up to there
    same = np.zeros(len(flat), bool)
    there = np.flatnonzero((row > 0) & (depth < lengths[np.maximum(row - 1, 0)]))
    same[there] = dense[there] == dense[first[row[there] - 1] + depth[there]]
    differing = np.concatenate([[0], np.cumsum(~same)])
    made = np.flatnonzero(differing[1:] > differing[first[row]])
    # its parent is the last node made one level up
    places = depth[made] * len(flat) + made
    order = np.argsort(places, kind="stable")
    last = np.searchsorted(places[order], (depth[made] - 1) * len(flat) + made, side="right") - 1
    parents = np.where(depth[made] > 0, order[np.maximum(last, 0)] + 1, 0)
    trie = DoubleArray(parents, dense[made])
    words = np.zeros(len(trie.check), np.int64)
    flat_words = np.asarray(shard["words"].combine_chunks().flatten()) if len(flat) else np.zeros(0, np.int64)
    words[trie.slot_of[1:]] = flat_words[made]

    size = len(trie.check)
    convs, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    deep, end_at = np.zeros(size, np.int64), np.zeros(len(raw), np.int64)
    state, alive, levels = np.zeros(len(raw), np.int64), np.arange(len(raw)), [np.zeros(1, np.int64)]
    np.add.at(convs, state, members)
    np.minimum.at(least, state, smallest)
    for d in range(int(lengths.max(initial=0))):
        alive = alive[lengths[alive] > d]
        state[alive] = trie.step(state[alive], dense[first[alive] + d])
        np.add.at(convs, state[alive], members[alive])
        np.minimum.at(least, state[alive], smallest[alive])
        levels.append(np.unique(state[alive]))
        deep[levels[-1]] = d + 1
    end_at[:] = state

    shared = np.zeros(size, bool)
    shared[0] = True
    chains = {}
    for path_row, reach in ((0, shard["reach_before"][0].as_py()), (len(raw) - 1, shard["reach_after"][0].as_py())):
        keys, s = _node_keys(raw[path_row], reach), 0
        chains[s] = keys[:1]
        for d in range(reach):
            s = int(trie.step(np.array([s]), dense[first[path_row] + d:first[path_row] + d + 1])[0])
            shared[s] = True
            chains[s] = keys[:d + 2]
    children = np.bincount(trie.check[trie.check >= 0], minlength=size)
    only_here = np.zeros(size, np.int64)
    np.add.at(only_here, trie.check[(trie.check >= 0) & ~shared], 1)
    leaves = np.where(~shared, children == 0, False).astype(np.int64)
    saved = np.where(~shared, (convs - 1) * words, 0)
    for level in reversed(levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    slots = np.concatenate(levels)
    up = trie.check[slots]
    inner = (up >= 0) & ~shared[np.maximum(up, 0)]
    text_end = np.full(size, None, object)
    text_end[end_at] = ends
    key = [chains[s][-1] if shared[s] else None for s in slots.tolist()]
    parent = [chains[u][-1] if u >= 0 and shared[u] else None for u in up.tolist()]
    above = [chains[s][:-1] if shared[s] else None for s in slots.tolist()]
    return pa.Table.from_arrays([
        pa.array(least[slots]), pa.array(deep[slots]), pa.array(least[np.maximum(up, 0)], mask=~inner), pa.array(convs[slots]),
        pa.array(np.where(shared, only_here, children)[slots]), pa.array(leaves[slots]), pa.array(saved[slots]), pa.array(text_end[slots], pa.string()),
        pa.array(words[slots]), pa.array(key, pa.binary()), pa.array(parent, pa.binary()), pa.array(above, pa.list_(pa.binary()))], schema=NODES)


def _shards(different: DataFrame, shard_turns: int) -> DataFrame:
    """Paths with their shard and how deep its first and last path go together with the shards beside it."""
    turns = different.agg(F.sum(F.length("path")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    n = max(1, math.ceil(((turns["bytes"] or 0) / TURN + turns["rows"]) / shard_turns))
    placed = written(different.repartitionByRange(n, "path").withColumn("shard", F.spark_partition_id()), "trie-shards")
    ends = placed.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))  # one row a shard
    w = Window.orderBy("shard")
    beside = ends.select("shard", "first", "last", F.lag("last").over(w).alias("before"), F.lead("first").over(w).alias("after"))

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def depth(a: bytes | None, b: bytes | None) -> int:
            if a is None or b is None:
                return 0
            low, high = 0, min(len(a), len(b)) // TURN
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if a[:mid * TURN] == b[:mid * TURN] else (low, mid - 1)
            return low
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("first", "last", "before", "after")), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array([depth(f, b) for f, _, b, _ in rows], pa.int32()),
                                              pa.array([depth(x, a) for _, x, _, a in rows], pa.int32())], names=["shard", "reach_before", "reach_after"])

    return placed.join(beside.mapInArrow(common, "shard int, reach_before int, reach_after int"), "shard")


def prefix_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                head: Column | None = None, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are taken in order of ``turn`` (null first), then role, then the text's hash; a null role
    or text is empty; repeated rows are turns of their own.  Rows without a conversation id take no
    part.  A conversation whose rebuilt form has no turn ends at the root.  An empty table has no
    nodes, not even a root.  A rebuilt conversation is one row of 20 bytes a turn.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD if head is None else head
    turns = written(_turns(df, id_col, turn_col, role_col, text_col), "trie-numbered")
    different = written(_different(written(paths(turns, head), "trie-paths")), "trie-different")
    nodes = written(_shards(different, shard_turns).groupBy("shard").applyInArrow(shard_nodes, _NODES_DDL), "trie-nodes")

    parts = nodes.where(F.col("node").isNotNull())
    merged = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.any_value("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("only_here"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("ends").alias("ends"), F.any_value("words").alias("words"),
        F.any_value("parent").alias("parent"), F.any_value("above").alias("above"))
    merged = written(merged, "trie-upper")
    kids = merged.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("shared_kids"))
    upper = merged.join(kids, "node", "left").withColumn("n_children", F.col("only_here") + F.coalesce("shared_kids", F.lit(0)))
    # a shared node's own share of leaves and savings, for itself and all above it
    own = upper.select(F.explode(F.concat("above", F.array("node"))).alias("node"), (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saving"))
    own = own.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    upper = upper.join(own, "node").withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("saving")})
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    upper = upper.join(names, "parent", "left").withColumn("parent_conv_id", F.col("above_id")).select(columns)
    lower = nodes.where(F.col("node").isNull())
    hung = lower.where(F.col("parent").isNotNull()).drop("parent_conv_id").join(names, "parent").withColumnRenamed("above_id", "parent_conv_id")
    whole = lower.where(F.col("parent").isNull()).select(columns).unionByName(hung.select(columns)).unionByName(upper)
    return whole.withColumn("ends", F.coalesce("ends", F.sha2(F.lit(""), 256))).withColumnRenamed("ends", "ends_sha256")

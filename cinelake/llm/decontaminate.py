"""Benchmark decontamination (7): one Aho-Corasick automaton over the windows of all test items.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all characters beyond ASCII.
Windows become ``" w1 ... w13 "`` strings in the automaton, a text is normalised to
``" w1 w2 ... "`` and scanned once; hits are mapped back to words and, through them, to code
points of the original text.

The automaton is built from the benchmark's normalised items, sent to tasks as broadcast
variables of at most ``BLOCK_BYTES`` each: about 400 bytes of automaton a byte, so 400 MB a block.
A benchmark within one block (any usual one) needs one automaton.  A larger one is scanned block
by block, with one block's automaton in memory at a time, built once for every ``HELD_BYTES`` of
texts of a task, and the hit words of a document are united over the blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import SLICE_ROWS, pick, slices

WINDOW = 13
# Normalised benchmark text of one automaton.
BLOCK_BYTES = 1 << 20
# Texts that a task holds while the blocks pass over them, if there are several (one row at least).
HELD_BYTES = 64 << 20

# Separators become spaces, A-Z lower case; bytes of characters beyond ASCII stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
# the same words in a text whose case is kept
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    # split(b" ") leaves empty strings; split() would also cut at nothing else, as the table leaves no other ASCII space
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def automaton(items: list[tuple[str, list[bytes]]], window: int) -> ahocorasick.Automaton:
    """Window string -> (number of words, ids of the items that hold it)."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, words in items:
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            key = (b" " + b" ".join(words[i:i + n]) + b" ").decode("utf-8", "surrogatepass")
            found.setdefault(key, (n, set()))[1].add(item)
    a = ahocorasick.Automaton()
    for key, value in found.items():
        a.add_word(key, value)
    if found:
        a.make_automaton()
    return a


def scan(a: ahocorasick.Automaton, joined: str, starts: list[int], hit: list[bool], items: set[str]) -> None:
    """Mark the words under any window of ``a`` in ``joined`` (words between single spaces)."""
    word_at: dict[int, int] = {}
    for end, (n, ids) in a.iter(joined):
        if not word_at:
            word_at.update((s, k) for k, s in enumerate(starts))
        after = word_at[end + 1] if end + 1 in word_at else len(starts)
        hit[after - n:after] = [True] * n
        items |= ids


def _sent(spark, benchmark: DataFrame, block_bytes: int, item_col: str, item_text_col: str) -> list:
    """Normalised items as broadcast variables of at most ``block_bytes`` (or one item) each."""
    sc = spark.sparkContext
    rows = pick(benchmark, item=item_col, text=item_text_col).where("text is not null").select(
        F.coalesce(F.col("item").cast("string"), F.lit("null")), F.col("text").cast("string")).toLocalIterator()
    sent, block, size = [], [], 0
    for item, text in rows:  # the stated query set; the driver holds one block at a time
        words = words_of(text)
        n = sum(map(len, words)) + len(words)
        if block and size + n > block_bytes:
            sent.append(sc.broadcast(block))
            block, size = [], 0
        block.append((item, words))
        size += n
    return [*sent, sc.broadcast(block)]


def _hits(a: ahocorasick.Automaton, texts: list[str | None], hits: dict[int, tuple[list[bool], set[str]]]) -> list[int]:
    """Unites into ``hits`` (text's place: (hit per word, item ids)) what ``a`` finds; returns the numbers of words."""
    sizes = []
    for k, text in enumerate(texts):
        words = words_of(text)
        sizes.append(len(words))
        joined = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass") if words and len(a) else ""
        if joined and next(a.iter(joined), None) is not None:
            starts, at = [], 1
            for w in words:
                starts.append(at)
                at += len(w.decode("utf-8", "surrogatepass")) + 1
            scan(a, joined, starts, *hits.setdefault(k, ([False] * len(starts), set())))
    return sizes


def _scanner(sent: list, window: int):
    """In a task: texts -> ([number of words], {text's place: (hit per word, item ids)}) of texts with a hit.

    The automaton of a single block is kept; of several, each is built once a call.
    """
    only = automaton(sent[0].value, window) if len(sent) == 1 else None

    def look(texts: list[str | None]) -> tuple[list[int], dict[int, tuple[list[bool], set[str]]]]:
        hits: dict[int, tuple[list[bool], set[str]]] = {}
        sizes: list[int] = []
        for b in sent:
            a = only if only is not None else automaton(b.value, window)
            sizes = _hits(a, texts, hits)
            del a  # before the next one is built
        return sizes, hits

    return look


def _held(batches: Iterator[pa.RecordBatch], column: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """The batches as they come for one block; for several, joined to about ``HELD_BYTES`` of texts."""
    held, size = [], 0
    for batch in batches:
        if blocks == 1:
            yield batch
            continue
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= HELD_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


_RESULT = "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted ids with a window in it), spans (hit runs, code points).

    An item shorter than ``window`` words is one window; null or wordless items have none; a null
    item id is called ``null``; items with the same id count once.  Null and empty documents have
    no words; null and repeated doc_ids are carried along, one result per row.
    """
    sent = _sent(docs.sparkSession, benchmark, block_bytes, item_col, item_text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _scanner(sent, window)
        for doc_ids, texts in slices(_held(batches, 1, len(sent)), SLICE_ROWS if len(sent) == 1 else 1 << 31):
            n_words, hits = look(texts)
            n_hit, items, spans = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
            for k, (hit, found) in hits.items():
                n_hit[k], items[k] = sum(hit), sorted(found)
                places = [m.span() for m in _WORD.finditer(texts[k])]
                for i, h in enumerate(hit):
                    if h and i and hit[i - 1]:
                        spans[k][-1]["end"] = places[i][1]
                    elif h:
                        spans[k].append({"start": places[i][0], "end": places[i][1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(items, pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_words", "n_hit", "items", "spans"])

    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _RESULT)


def contaminated(n_hit, n_words):
    """The contract's rule: some word is hit, and at least one in twenty is."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                      text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not ``contaminated``."""
    sent = _sent(docs.sparkSession, benchmark, block_bytes, item_col, item_text_col)

    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at, whole = names.index(text_col), len(sent) > 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = _scanner(sent, window)
        for batch in _held(batches, at, len(sent)):
            step = max(1, batch.num_rows) if whole else SLICE_ROWS
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                n_words, hits = look(part.column(at).to_pylist())
                yield part.filter(pa.array([k not in hits or not contaminated(sum(hits[k][0]), n) for k, n in enumerate(n_words)], pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)

"""Packing (1): concatenate all documents and cut the stream into fixed windows.

Pass 1 tokenises every text once and writes, per document, its ids and its start within its
partition.  The partition totals (one row per partition) are prefix-summed into global offsets.
Pass 2 is JVM-only: a document's global interval is cut at the multiples of the window; a piece
that touches a window edge is the boundary record of that window.

Ids: byte-level BPE.  Words between two single spaces are pre-tokens of their own, so their ids
are kept per word and a text is one dictionary lookup per word; words not yet seen are encoded
by rank merging over the same vocabulary, texts that hold a special token's string go through
the tokenizer file itself.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.common import pick, slices, written

WINDOW = 2048
END_ID = 1
# Words whose ids a task remembers (about 200 bytes each); more only costs time.
KNOWN_WORDS = 400_000

_EDGE = re.compile(r"\s | \s")


def default_tokenizer() -> tuple[str, str]:
    """Paths of the tokenizer file and of the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(tokenizer_path: str, ranks_path: str, known_words: int = KNOWN_WORDS) -> Callable[[str], bytes]:
    """text -> its ids as little-endian unsigned 32-bit integers."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = bpe.encode_ordinary
    known: dict[str, bytes] = {}
    full: list = []  # the tokenizer itself, loaded at the first text that needs it
    special = re.compile(re.escape("<|endoftext|>"))

    def packed(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(text: str) -> bytes:
        if special.search(text):
            if not full:
                full.append(Tokenizer.from_file(tokenizer_path))
            return packed(full[0].encode(text, add_special_tokens=False).ids)
        if _EDGE.search(text):  # white space beside a space: pre-tokens may reach over it
            return packed(plain(text))
        words = text.split(" ")
        out = list(map(known.get, words))
        out[0] = packed(plain(words[0]))
        for i in [i for i, v in enumerate(out) if v is None]:
            out[i] = v = packed(plain(" " + words[i]))
            if len(known) < known_words:
                known[words[i]] = v
        return b"".join(out)

    return encode


_TOKENS = "part int, doc_id bigint, local_start bigint, n bigint, ids binary"


def tokenise(docs: DataFrame, tokenizer: tuple[str, str] | None = None, end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, local_start, n, ids): ids with ``end_id`` behind them, ``local_start`` the ids before it in its partition."""
    paths = tokenizer or default_tokenizer()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = encoder(*paths), TaskContext.get().partitionId(), 0
        for doc_ids, texts in slices(batches):
            ids = [(encode(t) if t else b"") + end for t in texts]
            n = [len(x) // 4 for x in ids]
            starts = []
            for k in n:
                starts.append(at)
                at += k
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(n), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["part", "doc_id", "local_start", "n", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _TOKENS)


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: tuple[str, str] | None = None, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of ``docs`` in windows of ``window`` tokens; only the last window may be short.

    Returns doc_id, start (ids of the document before the piece), length, ids (binary, unsigned
    32-bit little-endian), doc_tokens, sequence_id, offset.  A null text counts as empty and
    still gives its end id; a null or repeated doc_id is carried along, every row is a document
    of its own; an empty table gives no pieces.
    """
    tokens = written(tokenise(pick(docs, doc_id=id_col, text=text_col), tokenizer, end_id), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # one row of 12 bytes for each input partition: bounded by the number of tasks, not by rows
    placed = tokens.join(F.broadcast(offsets), "part").withColumn("at", F.col("base") + F.col("local_start"))
    size = F.lit(window).cast("bigint")
    first, last = F.expr(f"at div {window}L"), F.expr(f"(at + n - 1) div {window}L")

    def piece(w):
        lo = F.greatest(w * size, F.col("at"))
        hi = F.least((w + 1) * size, F.col("at") + F.col("n"))
        start = lo - F.col("at")
        return F.struct(
            start.alias("start"), (hi - lo).alias("length"),
            F.substring(F.col("ids"), (start * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int")).alias("ids"),
            w.alias("sequence_id"), (lo - w * size).alias("offset"))

    pieces = F.transform(F.sequence(first, last), piece)
    return placed.select("doc_id", F.col("n").alias("doc_tokens"), F.inline(pieces)).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the windows themselves; a group holds at most one window of ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))

"""Toxicity (10): distance-weighted votes of the nearest labelled examples by exact TF-IDF cosine.

1. One pass turns every whole text into its term counts, written once.  A term is a word or a
   word's first ``BEGINNING`` letters, so inflected and compounded forms share terms; a term that a
   text repeats (twice or more, and in one of ``DENSE`` words) is a further term of its own.  All
   terms count, hashed to ``SLOTS`` numbers: memory has a bound, and terms of one number are one term.
2. Document frequencies are counted over all documents.
3. A bounded sample of labelled documents (``max_toxic`` and ``max_other`` rows, drawn by a hash of
   the id) gives the examples.  A term's weight is its idf, times 1 + ``MARK`` x the share of the
   class's entropy that the term explains among the examples, if it speaks for the toxic class:
   marking terms weigh more, but no term is left out of a vector or its length.
4. The examples' unit vectors form an inverted index, broadcast to the tasks: at most
   ``max_toxic + max_other`` vectors of at most ``SLOTS`` numbers, one table of ``SLOTS`` weights.
5. Every document asks it for its ``k`` nearest examples: the postings of all its terms are summed,
   terms that many examples hold by a matrix product, so the neighbours are exact.
6. The vote (similarity-weighted share of toxic neighbours) becomes a probability by a logistic
   curve fitted on leave-one-out votes of the examples.  A text without a term in common with any
   example gets the toxic share among the examples without a term.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import SLICE_ROWS, filter_rows, pick, slices, written

K = 15
MAX_TOXIC, MAX_OTHER = 2_000, 4_000
SLOTS = 1 << 21
# Weight of the entropy share that a term explains, and the G2 that chance alone reaches in one term of a hundred.
MARK, CHANCE = 600.0, 6.6
# Letters of the beginnings that are terms, and the words of a text of which one must be a repeated term.
BEGINNING, DENSE = 4, 150
# The examples of which more than one must hold a term of the matrix.
HEAD = 16
REJECT = 0.7

_WORD = re.compile(r"\w+")


def terms_of(text: str | None) -> Counter:
    """Terms of a whole text and how often they stand there."""
    words = _WORD.findall(text.lower()) if text else []
    found: Counter = Counter()
    for w, c in Counter(words).items():
        found[w] += c
        if len(w) > BEGINNING:
            found[w[:BEGINNING]] += c
    for t, c in list(found.items()):
        if c > 1 and c * DENSE >= len(words):
            found[t + "+"] = c  # no word holds a plus sign
    return found


def slots_of(terms: Iterable[str], n: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, map(str.encode, terms)), np.int64, n) % SLOTS


def _summed(slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some, at = np.unique(slots, return_inverse=True)
    return some, np.bincount(at, counts, minlength=len(some)).astype(np.int64)


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's slots, ascending, and how often their terms (``terms_of``) stand there."""
    words = _WORD.findall(text.lower()) if text else []
    found = Counter(words)
    n = np.fromiter(found.values(), np.int64, len(found))
    longer = np.fromiter(map(len, found), np.int64, len(found)) > BEGINNING
    begun = [w[:BEGINNING] for w in compress(found, longer.tolist())]
    slots, n = _summed(np.concatenate([slots_of(found, len(found)), slots_of(begun, len(begun))]), np.concatenate([n, n[longer]]))
    again = np.flatnonzero((n > 1) & (n * DENSE >= len(words)))
    if len(again):  # a repeated term's own slot follows from the term's
        slots, n = _summed(np.concatenate([slots, (slots[again] * 2_654_435_761 + 1) % SLOTS]), np.concatenate([n, n[again]]))
    return slots.astype(np.int32), n.astype(np.int32)


def held_out(doc_id):
    """True for the third of ids whose labels are never learnt; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_labels(labels: DataFrame, max_toxic: int, max_other: int, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, toxic) of the examples; rows without id or label and held-out ids are left out."""
    rows = (pick(labels, doc_id=id_col, toxic=label_col)
            .select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
            .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    draw = F.xxhash64("doc_id", F.lit(10)), F.col("doc_id")

    def some(toxic: int, n: int) -> DataFrame:
        return rows.where((F.col("toxic") > 0) == bool(toxic)).orderBy(*draw).limit(n).select("doc_id", F.lit(toxic).alias("toxic"))

    return written(some(1, max_toxic).unionByName(some(0, max_other)).coalesce(1), "labelled-sample")


def term_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, terms, tf): slots, ascending, and counts, of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            got = [counts_of(t) for t in texts]
            ends = np.concatenate([[0], np.cumsum([len(t) for t, _ in got])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(part))) for part in zip(*got, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *lists], names=["doc_id", "terms", "tf"])

    return docs.mapInArrow(run, "doc_id bigint, terms array<int>, tf array<int>")


def document_frequencies(counted: DataFrame) -> np.ndarray:
    """Documents by slot; every task counts into one array and hands on what is not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(SLOTS, np.int64)
        for batch in batches:
            some = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            df[some[0]] += some[1]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held], pa.int64())], names=["slot", "n"])

    got = counted.select("terms").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    df = np.zeros(SLOTS, np.int64)
    df[got["slot"].to_numpy()] = got["n"].to_numpy()
    return df


def entropy_share(terms: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """By slot: the share of the class's entropy that holding the term explains beyond chance; 0 where it does not speak for the toxic class."""
    def held(y: int) -> np.ndarray:
        some = [t for t, z in zip(terms, toxic, strict=True) if z == y]
        return np.bincount(np.concatenate(some), minlength=SLOTS) if some else np.zeros(SLOTS, np.int64)

    t, o = held(1), held(0)
    pos, neg = int(toxic.sum()), int(len(toxic) - toxic.sum())
    out = np.zeros(SLOTS)
    at = np.flatnonzero(t * neg > o * pos)
    t, o = t[at], o[at]
    all_ = (t + o) / (pos + neg)

    def part(seen, expected):
        return seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))

    g2 = 2 * (part(t, all_ * pos) + part(o, all_ * neg) + part(pos - t, (1 - all_) * pos) + part(neg - o, (1 - all_) * neg))
    most = -2 * (pos * math.log(pos / (pos + neg)) + neg * math.log(neg / (pos + neg)))
    out[at] = np.maximum(g2 - CHANCE, 0) / most
    return out


def vector(terms: np.ndarray, tf: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = (1 + np.log(tf)) * weight[terms]
    return terms, w / np.sqrt((w * w).sum())


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges first..end, one after the other."""
    n = end - first
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def inverted_index(vectors: list[tuple[np.ndarray, np.ndarray]]) -> dict:
    """Inverted index over unit vectors: the postings of each term, example and weight, from ``starts`` of its slot on.

    Terms that over one in ``HEAD`` examples holds stand in a matrix instead, term by example.
    """
    terms = np.concatenate([t for t, _ in vectors]).astype(np.int64)
    weights = np.concatenate([w for _, w in vectors]).astype(np.float32)
    example = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
    term, n = np.unique(terms, return_counts=True)
    head = term[n * HEAD > len(vectors)]
    dense = np.zeros((len(head), len(vectors)), np.float32)
    common = np.isin(terms, head)
    dense[np.searchsorted(head, terms[common]), example[common]] = weights[common]
    terms, weights, example = terms[~common], weights[~common], example[~common]
    order = np.lexsort((example, terms))
    starts = np.searchsorted(terms[order], np.arange(SLOTS + 1)).astype(np.int32)
    return {"head": np.append(head, SLOTS), "dense": dense, "starts": starts, "example": example[order], "weight": weights[order]}


block_max_index = inverted_index  # its name while it held block maxima


def nearest(index: dict, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave_out: int | None = None) -> list[list[tuple[float, int]]]:
    """Per vector the k examples of largest cosine over zero as (cosine to six places, example), ties by example.

    ``leave_out``: the first vector's own number as an example; the others' follow.
    """
    common = np.zeros((len(vectors), len(index["head"]) - 1), np.float32)
    for i, (t, w) in enumerate(vectors):
        at = np.searchsorted(index["head"], t)
        held = index["head"][at] == t
        common[i, at[held]] = w[held]
    base = common @ index["dense"]
    return [_search(index, t, w, base[i], k, -1 if leave_out is None else leave_out + i) for i, (t, w) in enumerate(vectors)]


def _search(index: dict, terms: np.ndarray, weights: np.ndarray, base: np.ndarray, k: int, own: int) -> list[tuple[float, int]]:
    """``nearest`` of one vector, from its similarity in the common terms (``base``)."""
    first, end = index["starts"][terms], index["starts"][terms + 1]
    held = np.flatnonzero(first < end)
    first, end = first[held].astype(np.int64), end[held]
    post = _ranges(first, end)
    rest = np.bincount(index["example"][post], np.repeat(weights[held], end - first) * index["weight"][post], minlength=len(base))
    score = (base + rest).round(6)
    if own >= 0:
        score[own] = 0
    least = np.partition(score, len(score) - k)[len(score) - k] if len(score) > k else 0
    found = np.flatnonzero((score >= least) & (score > 0))
    return [(s, e) for s, e in sorted(zip(score[found].tolist(), found.tolist(), strict=True), key=lambda x: (-x[0], x[1]))[:k]]


def vote(near: list[tuple[float, int]], toxic: np.ndarray) -> float:
    total = sum(s for s, _ in near)
    return sum(s for s, e in near if toxic[e]) / total if total else 0.0


def logistic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(toxic | vote), by Newton steps on smoothed targets; the slope is kept positive."""
    pos, neg = weights[labels > 0].sum(), weights[labels == 0].sum()
    y = np.where(labels > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([votes, np.ones_like(votes)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weights * (y - p)) - 1e-3 * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def fit(examples: list[tuple[int, int, np.ndarray, np.ndarray]], shares: dict[int, float], idf: np.ndarray, k: int) -> dict:
    """Weights, index, calibration and the score of documents without a term, from (doc_id, toxic, terms, tf) rows.

    ``shares``: labelled documents that one sampled example of the class stands for.
    """
    kept = [e for e in examples if len(e[2])]
    weight = idf * (1 + MARK * entropy_share([e[2] for e in kept], np.array([e[1] for e in kept], np.int64))) if kept else idf
    unit = [vector(e[2], e[3], weight) for e in kept]
    # examples with the same heaviest term side by side; ties between neighbours go by this order
    order = sorted(range(len(kept)), key=lambda i: (int(unit[i][0][unit[i][1].argmax()]), kept[i][0]))
    kept, vectors = [kept[i] for i in order], [unit[i] for i in order]
    toxic = np.array([e[1] for e in kept], np.int64)
    model = {"index": None, "toxic": toxic, "ids": [e[0] for e in kept], "weight": weight.astype(np.float32), "line": None}
    bare = Counter(e[1] for e in examples if not len(e[2]))
    model["bare"] = bare[1] * shares[1] / (bare[1] * shares[1] + bare[0] * shares[0] + 1) if examples else 0.0
    if kept:
        model["index"] = inverted_index(vectors)
        near = [n for at in range(0, len(vectors), SLICE_ROWS) for n in nearest(model["index"], vectors[at:at + SLICE_ROWS], k, at)]
        votes = np.array([vote(n, toxic) for n in near])
        model["line"] = logistic(votes, toxic, np.where(toxic > 0, shares[1], shares[0]))
    return model


def _scores(m: dict | None, counts: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[float, list[tuple[float, int]]]]:
    """Score and neighbours of documents by a fitted model (None: nothing was learnt)."""
    if m is None:
        return [(0.0, [])] * len(counts)
    held = [i for i, (terms, _) in enumerate(counts) if len(terms)] if m["line"] else []
    found = dict(zip(held, nearest(m["index"], [vector(*counts[i], m["weight"]) for i in held], k), strict=True)) if held else {}
    out = []
    for i in range(len(counts)):
        near = found.get(i)
        if near:
            slope, cut = m["line"]
            out.append((1 / (1 + math.exp(-max(-30.0, min(30.0, slope * vote(near, m["toxic"]) + cut)))), near))
        else:
            out.append((m["bare"], []))
    return out


def learn(docs: DataFrame, labels: DataFrame, k: int = K, max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER,
          id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
          label_col: str = "toxic") -> tuple[DataFrame, dict | None]:
    """(doc_id, terms, tf) of all documents, and the model: weights, index, labels, calibration (bounded; see above)."""
    texts = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    chosen = sample_labels(labels, max_toxic, max_other, label_id_col, label_col)
    counted = written(term_counts(texts), "term-counts")
    # at most max_toxic + max_other rows of an id and a label, and as many examples
    known = (counted.join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id").agg(F.min(F.struct("toxic", "terms", "tf")).alias("x")).select("doc_id", "x.*").toArrow())
    examples = [(i, y, np.array(t.values, np.int32), np.array(f.values, np.int32)) for i, y, t, f in
                zip(known["doc_id"].to_pylist(), known["toxic"].to_pylist(), known["terms"], known["tf"], strict=True)]
    drawn = Counter(e[1] for e in examples)
    if not drawn[0] or not drawn[1]:
        return counted, None
    idf = np.log((1 + counted.count()) / (1 + document_frequencies(counted))) + 1
    totals = {bool(r["toxic"]): r["n"] for r in pick(labels, doc_id=label_id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
              .where(~held_out(F.col("doc_id"))).groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.countDistinct("doc_id").alias("n")).collect()}
    shares = {y: max(1.0, totals.get(bool(y), 0) / drawn[y]) for y in (0, 1)}
    return counted, fit(examples, shares, idf, k)


_RESULT = "doc_id bigint, score double, evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>"


def score_documents(docs: DataFrame, labels: DataFrame, k: int = K, **options) -> DataFrame:
    """Per document: doc_id, score (0 to 1), evidence (its nearest examples), held_out.  ``options``: see ``learn``.

    Null and empty texts have no term and get the score of such examples; without examples of both
    classes every score is 0.  Repeated and null doc_ids are carried along, one result per row.
    With an equal similarity the example first in the index order (heaviest term, id) is nearer.
    """
    counted, model = learn(docs, labels, k, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                ids, terms, tf = batch.slice(at, SLICE_ROWS).columns
                end = np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))[:-1]
                rows = zip(np.split(terms.flatten().to_numpy(), end), np.split(tf.flatten().to_numpy(), end), strict=True)
                got = _scores(m, list(rows), k)
                ends = np.cumsum([0, *(len(near) for _, near in got)]).astype(np.int32)
                near = [e for _, some in got for _, e in some]
                evidence = pa.StructArray.from_arrays(
                    [pa.array([m["ids"][e] for e in near], pa.int64()), pa.array([s for _, some in got for s, _ in some], pa.float64()),
                     pa.array([int(m["toxic"][e]) for e in near], pa.int32())], ["doc_id", "similarity", "toxic"])
                yield pa.RecordBatch.from_arrays(
                    [ids.cast(pa.int64()), pa.array([s for s, _ in got], pa.float64()), pa.ListArray.from_arrays(pa.array(ends), evidence)],
                    names=["doc_id", "score", "evidence"])

    return counted.mapInArrow(run, _RESULT).withColumn("held_out", held_out(F.col("doc_id")))


def keep_clean(docs: DataFrame, labels: DataFrame, reject: float = REJECT, k: int = K, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``reject``; no shuffle of texts."""
    _, model = learn(docs, labels, k, text_col=text_col, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, text_col, lambda: lambda texts: [s < reject for s, _ in _scores(sent.value, [counts_of(t) for t in texts], k)])

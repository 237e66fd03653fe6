"""PII (5): patterns, and information-theoretic sanitisation of the terms that reveal them.

1. One pass over the texts finds e-mail addresses, IP addresses, card and phone numbers.  Each
   distinct value is a protected entity, and so is what several values share: a mail domain, an IP
   network, a card issuer, a phone prefix (``pooled``), so that values seen once are judged by their kin;
   what more than one document in ``POOL_RARITY`` mentions protects nobody.
   Texts with a mention are kept, and the words outside their mentions.
2. Entities that the same documents mention are one class: a contact list of E entities costs its
   words once, not E times.
3. Documents are counted per class (n_c), per word over the whole texts of all N documents (n_t), and
   per class and word (n_ct).  A word discloses a class by the chance that a document with the word
   mentions it, n_ct / (n_t + 1): the estimate is shrunk by one more document with the word and
   without the class, so a single coincidence stays at a half.  Its pointwise mutual information,
   log(chance N / n_c), must also be a good share of the class's own information, log(N / n_c): an
   entity of most documents has nothing to disclose.
4. Words at or above both thresholds are reported wherever they stand in a document that mentions the
   class: removed, or generalised to their class if they hold digits.

As n_ct is at most n_c, only words with n_t + 1 <= n_c / ``chance`` can reach the threshold; that
bound, not a cut, is what keeps common words out of the pairs.  Words are counted over all documents,
but only those that some paired document has: a bitmap of fixed size holds their hashes and lets a task
drop the others before the shuffle (a chance hit is counted and then joined away).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import pick, slices, written

KINDS = ["email", "ip", "card", "phone", "term"]
BASE = KINDS[:4]
CHANCE, SHARE = 0.6, 0.5
# A pool that more than one document in so many mentions (a public mail host) is nobody's.
POOL_RARITY = 8
# Bits of the filter of words worth counting: 4 MB, whatever the corpus.
FILTER_BITS = 1 << 25
# Words that a task counts before it hands its counts on.
_HELD_WORDS = 200_000
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and only from the start of a run of digits: no retries inside long runs
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @: the run before it, the labels behind it."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start, then kind."""
    found = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = "".join(_DIGITS.findall(m[0]))
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_DIGITS.findall(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity(text: str, kind: int) -> int:
    value = f"{KINDS[kind]}:" + ("".join(_DIGITS.findall(text)) if kind > 1 else text.lower())
    return xxhash.xxh64_intdigest(value.encode()) - (1 << 63)


def pooled(text: str, kind: int) -> int:
    """The entity that values of a kind share: mail domain, first three parts of an IP address, first six digits of a card, four of a phone number."""
    digits = "".join(_DIGITS.findall(text))
    value = (text.lower().rpartition("@")[2], text.rpartition(".")[0], digits[:6], digits[:4])[kind]
    return xxhash.xxh64_intdigest(f"{KINDS[kind]} pool:{value}".encode()) - (1 << 63)


def word_bit(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode(), 5) % FILTER_BITS


def words_outside(text: str, found: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(word, start, end) of the words of a whole text that touch no mention."""
    covered: list[list[int]] = []  # mentions, merged where they overlap
    for start, _, end in found:
        if covered and start < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    ends = [e for _, e in covered]
    for m in _WORD.finditer(text):
        i = bisect_left(ends, m.start() + 1)
        if i == len(ends) or covered[i][0] >= m.end():
            yield m[0].lower(), m.start(), m.end()


def clean_text(text: str, spans: list[tuple[int, str, int]]) -> str:
    """Base spans become their class mark; terms with digits ``[NUMBER]``, other terms vanish.  Overlaps: the first span rules."""
    out, at = [], 0
    for start, kind, end in spans:
        if start < at:
            at = max(at, end)
            continue
        out += [text[at:start], MARKS.get(kind) or ("[NUMBER]" if _DIGITS.search(text[start:end]) else "")]
        at = end
    return "".join([*out, text[at:]])


_FOUND = "doc_id bigint, text string, base array<struct<start:bigint,kind:int,end:bigint>>, entities array<struct<id:bigint,pool:boolean>>, words array<string>"
_ENTITIES = pa.list_(pa.struct([("id", pa.int64()), ("pool", pa.bool_())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))


def _look(docs: DataFrame, with_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            base = [entities(t) if t else [] for t in texts]
            known = [[{"id": i, "pool": p} for i, p in sorted({(make(t[s:e], k), make is pooled) for s, k, e in f for make in (entity, pooled)})]
                     for t, f in zip(texts, base, strict=True)]
            words = [sorted({w for w, _, _ in words_outside(t, f)}) if f else [] for t, f in zip(texts, base, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([t if f or with_text else None for t, f in zip(texts, base, strict=True)], pa.string()),
                 pa.array([[dict(zip(("start", "kind", "end"), x, strict=True)) for x in f] for f in base], _SPANS),
                 pa.array(known, _ENTITIES), pa.array(words, pa.list_(pa.string()))],
                names=["doc_id", "text", "base", "entities", "words"])

    return written(docs.mapInArrow(run, _FOUND).withColumn("row", F.monotonically_increasing_id()), "pii-found")


def _words_to_count(words: DataFrame) -> bytes:
    """Bitmap of the hashes of the words; ``words`` may repeat them."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {word_bit(w) for w in batch.column(0).to_pylist()}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["bit"])

    width = 32_768  # bits of one of Spark's bitmaps
    maps = words.mapInArrow(bits, "bit bigint").groupBy(F.floor(F.col("bit") / width).cast("int").alias("part")).agg(
        F.bitmap_construct_agg((F.col("bit") % width)).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for row in maps.collect():  # at most FILTER_BITS / 32,768 rows of 4 KB
        out[row["part"] * width // 8:row["part"] * width // 8 + len(row["bits"])] = row["bits"]
    return bytes(out)


def document_frequencies(docs: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """(word, n_t): documents that hold a word, over the whole texts of all documents; only words in the bitmap ``wanted`` if given."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)  # FILTER_BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        bits, counts, passed = sent.value, Counter(), {}
        for (texts,) in slices(batches):
            for text in texts:
                words = {w.lower() for w in _WORD.findall(text or "")}
                if bits is not None:
                    for w in words:
                        if w not in passed:
                            bit = word_bit(w)
                            passed[w] = bits[bit >> 3] >> (bit & 7) & 1
                    words = {w for w in words if passed[w]}
                counts.update(words)
                if len(counts) > _HELD_WORDS:
                    yield out(counts)
                    counts = Counter()
                if len(passed) > _HELD_WORDS:
                    passed = {}
        yield out(counts)

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n_t"))


def disclosing(docs: DataFrame, found: DataFrame, chance: float = CHANCE, share: float = SHARE) -> DataFrame:
    """(row, word): words of a document that disclose an entity which it mentions."""
    total = F.lit(float(found.count()))
    seen = found.where(F.size("entities") > 0).select("row", F.explode("entities").alias("e")).select("row", F.col("e.id").alias("entity"), "e.pool")
    # an entity of one document has n_ct <= 1 <= n_t, a chance of a half at most: only entities of more are paired
    least = 1 if chance <= 0.5 else 2
    sets = seen.groupBy("entity", "pool").agg(F.count(F.lit(1)).alias("n_c"), *[F.expr(f"bit_xor(xxhash64(row, {i}))").alias(f"s{i}") for i in (1, 2)])
    sets = sets.where((F.col("n_c") >= least) & (~F.col("pool") | (F.col("n_c") * POOL_RARITY <= total)))
    same = ["n_c", "s1", "s2"]      # the same documents
    classes = sets.join(sets.groupBy(*same).agg(F.min("entity").alias("class")), same).select("entity", "class", "n_c")
    members = written(seen.join(classes, "entity").select("row", "class", "n_c").distinct(), "pii-members")
    widest = members.groupBy("row").agg(F.max("n_c").alias("most"))
    words = written(found.join(widest, "row").select("row", "most", F.explode("words").alias("word")), "pii-words")
    n_t = written(document_frequencies(docs, _words_to_count(words.select("word"))), "pii-frequencies")
    reach = (F.col("n_t") + 1) * chance
    rare = words.join(n_t, "word").where(reach <= F.col("most")).select("row", "word", "n_t")
    viable = written(rare.join(members, "row").where(reach <= F.col("n_c")), "pii-viable")
    n_ct = viable.groupBy("class", "word", "n_c", "n_t").agg(F.count(F.lit(1)).alias("n_ct"))
    p = F.col("n_ct") / (F.col("n_t") + 1)
    own = F.log(total / F.col("n_c"))
    told = n_ct.where((p >= chance) & (own > 0) & (F.log(p * total / F.col("n_c")) >= share * own)).select("class", "word")
    return viable.join(told, ["class", "word"], "left_semi").select("row", "word")


def protect(docs: DataFrame, chance: float = CHANCE, share: float = SHARE,
            id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: doc_id, spans (kind, start, end in code points) by start, then kind; ``with_text`` adds clean_text.

    Base spans are always there; spans of kind ``term`` are words that disclose an entity (or what
    several entities share) which the same document mentions, wherever they stand in it.  An entity in
    every document has nothing to disclose.  Copies of a text count as documents of their own.
    Null and empty texts have no spans; null and repeated doc_ids are carried along, one result
    per row; an empty table gives no rows.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = _look(rows, with_text)
    terms = disclosing(rows, found, chance, share).groupBy(F.col("row").alias("term_row")).agg(F.collect_set("word").alias("terms"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, base, told in slices(batches):
            spans = []
            for text, known, words in zip(texts, base, told, strict=True):
                if words:
                    words, mentions = set(words), [(x["start"], x["kind"], x["end"]) for x in known]
                    known = known + [{"start": s, "kind": 4, "end": e} for w, s, e in words_outside(text, mentions) if w in words]
                    known.sort(key=lambda x: (x["start"], x["kind"], x["end"]))
                spans.append(known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts if with_text else [None] * len(ids), pa.string()), pa.array(spans, _SPANS)],
                names=["doc_id", "text", "listed"])

    listed = (found.drop("words").join(terms, F.col("row") == F.col("term_row"), "left").select("doc_id", "text", "base", "terms")
              .mapInArrow(mark, "doc_id bigint, text string, listed array<struct<start:bigint,kind:int,end:bigint>>"))
    name = F.array(*[F.lit(k) for k in KINDS])
    out = listed.select("doc_id", "text", F.transform("listed", lambda x: F.struct(
        F.element_at(name, x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))
    if not with_text:
        return out.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            done = [t and clean_text(t, [(x["start"], x["kind"], x["end"]) for x in s]) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(done, pa.string())], names=["doc_id", "spans", "clean_text"])

    return out.mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>, clean_text string")

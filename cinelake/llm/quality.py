"""Quality rules (2), line first: failing lines go, then documents that lost too much text.

Every line of a text is held against three rules; a line that fails one is removed:

* punctuation: nothing but symbols, or more than ``SYMBOLS_PER_WORD`` symbols for each word, or a
  fragment of under ``FRAGMENT_WORDS`` words without a closing mark;
* navigation: two or more separators that make up ``SEPARATORS_PER_WORD`` of the words, or a
  bulleted entry that is a fragment;
* boilerplate: a short line with a phrase that sites put on every page, or a line equal to an
  earlier one of the same text.

A document is kept if it passes the base rules (length, repetition) and loses at most
``MOST_LOST`` of its characters in words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import pick, slices

LEAST_WORDS, MOST_REPEATED = 50, 0.5
SYMBOLS_PER_WORD, SEPARATORS_PER_WORD = 0.2, 0.15
FRAGMENT_WORDS, BOILERPLATE_WORDS = 6, 30
MOST_LOST = 0.4

SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
_CLOSED = re.compile(r"""[.!?:;…。！？]["'”’»)\]]*\s*$""")
_SYMBOL = re.compile(r"[#*$%&|<>~^=_{}\\@]")
_SEPARATOR = re.compile(r"[|»›•·→]|(?<!\S)[>/](?!\S)")
_BULLET = re.compile(r"\s*(?:[-*•·»>]|\d{1,2}[.)])\s")
_PLAIN = re.compile(r"[^\W_]")
_PHRASE = re.compile(
    r"(?i)\b(?:cookies?|privacy policy|terms of (?:use|service)|all rights reserved|javascript|lorem ipsum|sign (?:in|up)|log ?in"
    r"|subscribe|newsletter|click here|read more|share (?:this|on)|skip to|back to top"
    r"|datenschutz|impressum|alle rechte vorbehalten|anmelden|mentions légales|tous droits réservés|s'abonner"
    r"|política de privacidad|todos los derechos reservados|suscríbete)\b")

RULES = ("punctuation", "navigation", "boilerplate")


def failed_rule(line: str, words: int) -> str | None:
    """The first rule that a line of ``words`` words fails."""
    if not _PLAIN.search(line) or len(_SYMBOL.findall(line)) > SYMBOLS_PER_WORD * words + 1:
        separators = len(_SEPARATOR.findall(line))
        return "navigation" if separators > 1 and separators >= SEPARATORS_PER_WORD * words else "punctuation"
    separators = len(_SEPARATOR.findall(line))
    if separators > 1 and separators >= SEPARATORS_PER_WORD * words:
        return "navigation"
    if words < FRAGMENT_WORDS and not _CLOSED.search(line):
        return "navigation" if _BULLET.match(line) else "punctuation"
    if words < BOILERPLATE_WORDS and _PHRASE.search(line):
        return "boilerplate"
    return None


def repeated_words(words: list) -> int:
    """Words that stand in a window of three words found at least twice."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    first: dict = {}
    covered = bytearray(len(words))
    if len(set(windows)) == len(windows):
        return 0
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            covered[j:j + 3] = covered[i:i + 3] = b"\1\1\1"
    return covered.count(1)


def measure(text: str | None) -> tuple[int, int, int, int, int, bool, dict[str, int], str, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed lines by rule, clean text, kept."""
    text = text or ""
    words = text.encode().split()  # bytes: ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    repeated = repeated_words(words)
    base_failed = n < LEAST_WORDS or repeated > MOST_REPEATED * n
    seen: set[str] = set()
    removed = dict.fromkeys(RULES, 0)
    left, lost, doubles = [], 0, 0
    for line in text.split("\n"):
        k = len(line.encode().split())
        if not k:
            left.append(line)
            continue
        rule = "boilerplate" if line in seen else failed_rule(line, k)
        doubles += line in seen
        seen.add(line)
        if rule:
            removed[rule] += 1
            lost += len(line) - sum(map(line.count, _SPACE))
        else:
            left.append(line)
    kept = not base_failed and lost <= MOST_LOST * chars
    return n, chars, symbols, doubles, repeated, base_failed, removed, "\n".join(left), kept


_RESULT = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, kept boolean, removed map<string,bigint>, clean_text string")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, removed (lines by rule), clean_text (what lines are left).

    Null and empty texts have no words and fail the base rules; null and repeated doc_ids are
    carried along, one result per row; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            got = list(zip(*map(measure, texts), strict=True))
            removed = pa.array([list(x.items()) for x in got[6]], pa.map_(pa.string(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in got[:5]), pa.array(got[5], pa.bool_()),
                 pa.array(got[8], pa.bool_()), removed, pa.array(got[7], pa.string())],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed", "clean_text"])

    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _RESULT)

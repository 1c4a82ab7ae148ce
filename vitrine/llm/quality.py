"""Line-first quality rules.

Each line is judged by rules on its end, on navigation and on boilerplate; lines that fail go. A
document that loses too much of its text with them is rejected, and so is one that fails the base
rules (too few words, too much repetition).
"""

from __future__ import annotations

import re
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import code_points, map_texts, pieces, shingle_hashes, sums_by, word_hashes, words
from vitrine.llm.storage import quoted

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
WINDOW = 8
LEAST_STUTTER = 8  # words of a line from which words that follow themselves are counted
LEAST_KEPT = 50  # per cent of word characters in lines that pass

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

# fixed values: marks that end a sentence, in Latin, Devanagari, Arabic, Armenian, Ethiopic, Khmer, Burmese and
# East Asian scripts; the last of these need no space after them
_END = re.compile(r"[.!?:;…।॥؟۔։።។။。．！？；：｡][\"'”’»」』）)\]]*$")
_SENTENCE = re.compile(r"[.!?…।॥؟۔։።។။][\"'”’»)\]]*\s|[。．！？｡]")
# fixed values: scripts that do not part words, of which two characters are taken for a word
_UNPARTED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
LONG_LINE = 12  # words from which a line may lack an end if a sentence ends in it
# fixed values: what stands between the links of a menu
_BETWEEN = re.compile(r"[|»›·•]|(?<=\s)(?:>|/|-|–)(?=\s)")
# fixed values: symbols glued to words or alone
_NOISE = re.compile(r"[#*$%&|<>{}~^=_\\]{2,}")
# fixed values: phrases of site chrome and licences
_BOILERPLATE = re.compile(
    r"all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|we use cookies|accept cookies"
    r"|enable javascript|click here|sign up|log in|subscribe to|read more|share on|back to top|lorem ipsum"
    r"|copyright (?:\(c\)|©|\d{4})|(?:licensed|released) under|spdx-license-identifier|powered by",
    re.IGNORECASE,
)
BOILERPLATE_SHARE = 10  # per cent of a sentence that such phrases make up in boilerplate
_PRELUDE = re.compile(r"[{}|#*$%&<>»›·•~^=_\\]")


def _n_words(line: str) -> int:
    return line.count(" ") + 1 + (0 if line.isascii() else len(_UNPARTED.findall(line)) // 2)


def _is_boilerplate(line: str) -> bool:
    """True if most of a line is sentences that such phrases make up a good part of."""
    if not _BOILERPLATE.search(line):
        return False
    start, bad = 0, 0
    for end in [*(m.end() for m in _SENTENCE.finditer(line)), len(line)]:
        phrases = sum(len(m[0]) for m in _BOILERPLATE.finditer(line, start, end))
        if 100 * phrases >= BOILERPLATE_SHARE * (end - start) > 0:
            bad += end - start
        start = end
    return 2 * bad > len(line)


def line_passes(line: str) -> bool:
    """True if a line (with a word) reads as text."""
    line = line.strip()
    if not _END.search(line) and (_n_words(line) < LONG_LINE or not _SENTENCE.search(line)):
        return False
    if _PRELUDE.search(line):
        n = line.count(" ") + 1
        if len(_BETWEEN.findall(line)) * 4 > n or len(_NOISE.findall(line)) * 5 > n:
            return False
    if line.isupper() and len(line) >= 20:
        return False
    said = line.split()
    if len(said) >= LEAST_STUTTER and 2 * sum(map(eq, said, said[1:])) > len(said):
        return False
    return not _is_boilerplate(line)


def _lines(text: str, n_chars: int) -> tuple[int, int, list[str]]:
    """Repeated lines, word characters in lines that pass, and those lines."""
    repeated, passed, seen, kept = 0, 0, set(), []
    for line in text.split("\n"):
        if not line.strip(" \t\n\r\x0b\x0c"):
            continue
        if line in seen:
            repeated += 1
        else:
            seen.add(line)
        if line_passes(line):
            passed += len(line) - sum(map(line.count, " \t\r\x0b\x0c"))
            kept.append(line)
    return repeated, passed, kept


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each document the words that lie in a window found twice or more in it."""
    n_docs, n_words = len(first) - 1, int(first[-1])
    out = np.zeros(n_docs, np.int64)
    if n_words < WINDOW:
        return out
    windows = shingle_hashes(hashes, WINDOW)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    own = np.flatnonzero(doc[: len(windows)] == doc[WINDOW - 1 :])
    keys = windows[own] ^ (doc[own].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, own[twice], 1)
    np.add.at(edge, own[twice] + WINDOW, -1)
    return sums_by(np.cumsum(edge[:-1]) > 0, first)


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, kept_chars long, clean_text string"
)


def judge(docs: DataFrame, id_cols: list[str], text_col: str = "text", clean: bool = True) -> DataFrame:
    """The id columns, the counts, the verdict and, unless `clean` is off, the text without failing lines.

    Null and empty texts have no words and are rejected. Rows are independent: repeated rows give
    repeated results, an empty table an empty one. Other columns are ignored.
    """

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        n = batch.num_rows
        counts = {k: np.zeros(n, np.int64) for k in ("words", "chars", "symbols", "lines", "repeats", "passed")}
        texts: list[str] = []
        for i, j, data, offsets in pieces(batch, batch.num_columns - 1):
            w = words(data, offsets)
            counts["words"][i:j] = np.diff(w.first)
            lead = np.append(0, np.cumsum(code_points(data)))
            counts["chars"][i:j] = sums_by(lead[w.ends] - lead[w.starts], w.first)
            counts["symbols"][i:j] = sums_by(_SYMBOL[data], offsets)
            counts["repeats"][i:j] = repeated_words(word_hashes(data, w), w.first)
            raw = data.tobytes()
            for k in range(j - i):
                text = raw[offsets[k] : offsets[k + 1]].decode("utf-8", "replace")
                counts["lines"][i + k], counts["passed"][i + k], lines = _lines(text, len(text))
                texts.append("\n".join(lines) if clean else "")
        failed = (counts["words"] < LEAST_WORDS) | (100 * counts["repeats"] > MOST_REPEATED * counts["words"])
        kept = ~failed & (100 * counts["passed"] >= LEAST_KEPT * counts["chars"])
        return [*map(pa.array, (*(counts[k] for k in ("words", "chars", "symbols", "lines", "repeats")), failed, kept, counts["passed"])), pa.array(texts, pa.string())]

    return map_texts(docs, id_cols, text_col, FIELDS, work)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, kept and kept_chars for every document (see judge)."""
    return judge(docs, [id_col], text_col, clean=False).drop("clean_text").withColumnRenamed(id_col, "doc_id")


def good_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep, without their failing lines; columns as they were.

    n_chars, where it is there, follows the new text.
    """
    others = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*map(quoted, others)).alias("row"), text_col)
    judged = judge(packed, ["row"], text_col).filter("kept")
    values = {c: F.col("row").getField(c) for c in others} | {text_col: F.col("clean_text")}
    if "n_chars" in others:
        values["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return judged.select(*[values[c].alias(c) for c in docs.columns])

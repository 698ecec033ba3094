"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too much text go.

Results for unusual rows: a null text has no words and null ``clean_text``, and counts as an empty one, which fails
the base rule (fewer than ``min_words`` words). Repeated rows are judged alike, one result each. A null id is passed
through. Other columns are not read. A very long text costs time and memory in proportion to its length.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from ledgertone.llm.batches import id_and_text, id_type, map_slices, row_schema, whole_rows, with_new_text

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8
# Phrases of licence, copyright and site notices, in lower case.
NOTICES = (
    "all rights reserved", "licensed under", "released under the", "this work is licensed", "terms of use",
    "terms of service", "privacy policy", "cookie policy", "accept cookies", "enable javascript",
    "subscribe to our newsletter", "powered by wordpress", "copyright ©", "copyright (c)",
)
BARS = frozenset((b"|", "»".encode(), "•".encode(), "›".encode(), b">", b"/"))
_BAR = re.compile(b"|".join(map(re.escape, sorted(BARS))))
_SHOUT = re.compile(rb"[!?]{2}")
_DRESSED = re.compile(rb"[#*$%&|<>]")
_LETTER = re.compile(rb"[0-9A-Za-z\x80-\xff]")

# Words of a slice lie in memory one by one, with numbers for their windows, at over twenty times their text.
SLICE_BYTES = 1 << 20
RULES = ("punctuation", "navigation", "repetition", "boilerplate")


def line_rule(line: bytes, notice_words: int = 20) -> int:
    """0 for a line that stays, otherwise 1 + the place of the first rule in RULES that it fails.

    punctuation: no letter or digit at all; symbols make up more than a tenth of the line's characters (bytes) outside
    spaces; or more than three tenths of its words hold two exclamation or question marks in a row.
    navigation: at least two separator words, and at least a fifth of all words.
    repetition: at least four words, and more than half of them equal the word before.
    boilerplate: a notice phrase in a line of at most ``notice_words`` words.
    """
    words = line.split()
    n = len(words)
    if not n:
        return 0
    if not _LETTER.search(line):
        return 1
    solid = sum(map(len, words))
    if 10 * len(_DRESSED.findall(line)) > solid:
        bars = sum(w in BARS for w in words)
        return 2 if bars >= 2 and 5 * bars >= n else 1
    if b"!!" in line or b"??" in line or b"!?" in line or b"?!" in line:
        if 10 * sum(_SHOUT.search(w) is not None for w in words) > 3 * n:
            return 1
    if n >= 10 or _BAR.search(line) is not None:
        bars = sum(map(BARS.__contains__, words))
        if bars >= 2 and 5 * bars >= n:
            return 2
    if n >= 4 and 2 * sum(map(bytes.__eq__, words[1:], words)) > n:
        return 3
    if n <= notice_words:
        low = line.lower().decode("utf-8", "replace")
        if any(p in low for p in NOTICES):
            return 4
    return 0


def repeated_words(texts: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """For each text: words in windows of ``window`` words that occur twice or more in it, the first included.

    Windows are named by doubling: equal numbers mean equal word sequences, so no hash can collide. ``window`` must
    be a power of two.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(lengths.sum())
    if total < window:
        return np.zeros(len(texts), np.int64)
    words = np.empty(total, object)
    at = 0
    for text in texts:
        words[at:at + len(text)] = text
        at += len(text)
    name = pd.factorize(words)[0].astype(np.int64)
    step = 1
    while step < window:
        name = pd.factorize(name[:-step] * (int(name.max()) + 1) + name[step:])[0].astype(np.int64)
        step *= 2
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = np.flatnonzero(owner[:len(name)] == owner[window - 1:])
    if not len(inside):
        return np.zeros(len(texts), np.int64)
    codes = pd.factorize(name[inside] * len(texts) + owner[inside])[0]
    starts = inside[np.bincount(codes)[codes] > 1]
    cover = np.zeros(total + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + window, 1)
    return np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=len(texts))


def judged(texts: list[str | None], min_words: int, max_repeat_pct: int, max_lost_pct: int, notice_words: int) -> dict:
    """Counts, verdicts and cleaned texts of a slice of documents, by column."""
    raw = [t.encode() if t else b"" for t in texts]
    words = [t.split() for t in raw]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    repeats = repeated_words(words)
    base_failed = (n_words < min_words) | (100 * repeats > max_repeat_pct * n_words)
    chars, symbols, dups, bad, lost_pct, kept, clean = [], [], [], [], [], [], []
    for i, (text, data) in enumerate(zip(texts, raw)):
        text = text or ""
        chars.append(len(text) - sum(map(text.count, SPACES)))
        symbols.append(sum(map(text.count, SYMBOLS)))
        lines = data.split(b"\n")
        full = [x for x in lines if x.strip()]
        dups.append(len(full) - len(set(full)))
        rule = [line_rule(x, notice_words) for x in lines]
        failed = sum(map(bool, rule))
        solid = sum(map(len, words[i]))
        lost = sum(sum(map(len, x.split())) for x, r in zip(lines, rule) if r) if failed else 0
        left = sum(len(x.split()) for x, r in zip(lines, rule) if not r) if failed else int(n_words[i])
        bad.append(failed)
        lost_pct.append(100.0 * lost / solid if solid else 0.0)
        kept.append(bool(not base_failed[i] and left >= min_words and 100 * lost <= max_lost_pct * solid))
        if texts[i] is None or not failed:
            clean.append(texts[i])
        else:
            clean.append(b"\n".join(x for x, r in zip(lines, rule) if not r).decode())
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dups, "n_repeat_words": repeats,
        "base_failed": base_failed, "kept": kept, "n_bad_lines": bad, "lost_pct": lost_pct, "clean_text": clean,
    }


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, max_repeat_pct: int = 30,
    max_lost_pct: int = 50, notice_words: int = 20,
) -> DataFrame:
    """One row per document: counts, the base rule, the verdict and the cleaned text.

    ``kept`` is false if the base rule fails, if more than ``max_lost_pct`` percent of the bytes in words lie in lines
    that fail a rule, or if the other lines have fewer than ``min_words`` words. ``clean_text`` is the text without the
    failing lines.
    """

    def start():
        return lambda piece: [
            piece.column("doc_id"),
            *judged(piece.column("text").to_pylist(), min_words, max_repeat_pct, max_lost_pct, notice_words).values(),
        ]

    schema = (
        f"doc_id {id_type(docs, id_col)}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, n_bad_lines long, lost_pct double, clean_text string"
    )
    return map_slices(id_and_text(docs, id_col, text_col), schema, start, limit=SLICE_BYTES)


def cleaned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, max_repeat_pct: int = 30,
    max_lost_pct: int = 50, notice_words: int = 20,
) -> DataFrame:
    """The documents that ``quality_rules`` keeps, all columns, with the cleaned text."""
    rows = whole_rows(docs, id_col, text_col)

    def start():
        def run(piece):
            found = judged(
                piece.column("text").to_pylist(), min_words, max_repeat_pct, max_lost_pct, notice_words
            )
            stays = pa.array(found["kept"])
            return [piece.column("row").filter(stays), pa.array(found["clean_text"], pa.string()).filter(stays)]

        return run

    schema = row_schema(rows, StructField("new_text", StringType()))
    done = map_slices(rows.select("row", "text"), schema, start, limit=SLICE_BYTES)
    return with_new_text(done, docs.columns, text_col)

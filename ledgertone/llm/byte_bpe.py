"""Byte-level BPE with the tiktoken library and a local rank file: ids of whole texts, and bytes of ids.

Long texts are split where a run of white space follows another character. No match of the pattern reaches over such a
place, and what a match looks ahead to is unchanged, so the pieces' ids in order are the ids of the whole text.

The pattern engine cannot match runs of about a million white-space characters. The pattern takes such a run whole where
the text ends, else all but its last character, which goes with what follows; longer runs than ``RUN_CHARS`` are taken
out like that and encoded by the ranks directly.

Results for unusual rows: null and empty texts have no ids and decode to empty bytes; repeated rows give repeated
results; a null id is passed through; other columns are not read.
"""

import base64
import re

import numpy as np
import tiktoken
from pyspark.sql import DataFrame

from ledgertone.llm.batches import id_and_text, id_type, map_slices

PIECE_CHARS, RUN_CHARS = 1 << 16, 1 << 12
# White space as the pattern engine knows it, which is less than Python's.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BOUNDARY = re.compile(rf"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_LONG_RUN = re.compile(rf"(?<![{_WHITE}])[{_WHITE}]{{{RUN_CHARS},}}+")


def load_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def load_encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=load_ranks(rank_file), special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text, cut at the first safe boundary after each ``size`` characters; without one it stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _BOUNDARY.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


def encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= RUN_CHARS:
        return encoding.encode_ordinary(text)
    ids, at = [], 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        for part in pieces(text[at:run.start()]):
            ids += encoding.encode_ordinary(part)
        ids += encoding._core_bpe.encode_single_piece(text[run.start():end].encode())
        at = end
    for part in pieces(text[at:]):
        ids += encoding.encode_ordinary(part)
    return ids


def decode(encoding: tiktoken.Encoding, ids: list[int]) -> bytes:
    """Raw bytes; they need not be valid UTF-8 when ids come from elsewhere."""
    return encoding.decode_bytes(ids)


def byte_bpe(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    derive=None, derived: str = "ids array<int>, decoded binary",
) -> DataFrame:
    """One row per document: ``n_tokens``, ``ids`` and ``decoded`` (the bytes that the ids stand for).

    The rank file is read once in each task, from a path that every executor has. ``derive(ids, decoded)`` may replace
    the last two columns by values made of them where they arise, described by ``derived``; a caller who needs only
    digests then moves no ids.
    """

    def start():
        encoding = load_encoding(rank_file, pattern)

        def run(piece):
            counts, rows = [], []
            for text in piece.column("text").to_pylist():
                ids = encode(encoding, text) if text else []
                back = decode(encoding, ids)
                counts.append(len(ids))
                rows.append(derive(ids, back) if derive else (ids, back))
            return [piece.column("doc_id"), np.asarray(counts, np.int64), *map(list, zip(*rows))]

        return run

    schema = f"doc_id {id_type(docs, id_col)}, n_tokens long, {derived}"
    return map_slices(id_and_text(docs, id_col, text_col), schema, start)

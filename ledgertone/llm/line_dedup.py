"""Repeated passages of several lines, found as content-defined chunks at two levels.

A rolling hash over the hashes of the last ``window`` lines ends a chunk where it is divisible by ``spacing``. Where a
chunk ends depends on the lines just before only, so a passage is cut alike in every document that holds it, wherever
it stands. A chunk counts if at least ``min_lines`` of its lines hold a word.

Chunks of a few lines straddle the ends of a short passage, so there is a finer level, for which each line that holds a
word is an end: two such lines that follow each other (blank ones aside) are a small chunk if they have ``min_words``
words together. Small chunks overlap, so every passage of two lines or more is made of them, up to its outermost lines.
A line of ``long_line`` words is a passage by itself: many texts have a whole paragraph on one line.

Chunks of either level and long lines whose bytes occur before (in a smaller doc_id, or earlier in the document) are
removed with all their lines that hold a word; a chunk with its blank lines too. The first of equal lines always stays.

Results for unusual rows: a null text stays null, an empty one empty; neither has chunks. Rows that repeat an id and
its text count as one document and get the same result; rows with the same id and other texts are documents of their
own, ordered by a hash of the text. A null id comes before all others. All columns are returned as they were but for
the text; names of other columns do not matter. Documents of any length are cut whole.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from ledgertone.llm.batches import id_type, map_slices, parsed, row_schema, whole_rows, with_new_text
from ledgertone.llm.components import staged
from ledgertone.llm.hash_filter import hash_filter, may_hold

WINDOW, SPACING, MIN_LINES = 2, 3, 2
MIN_WORDS, LONG_LINE = 10, 50
BASE, MODULUS = 31, 1 << 32
COARSE, FINE, LINE = range(3)


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.md5(line, usedforsecurity=False).digest()[:4], "big")


def chunk_ends(lines: list[bytes], window: int = WINDOW, spacing: int = SPACING) -> list[int]:
    """Places after the last line of each chunk. The hash of line i is the sum over j < window of
    BASE**j * line_hash(i - j), rolled forward from line to line."""
    gone = pow(BASE, window, MODULUS)
    hashes = list(map(line_hash, lines))
    rolled, ends = 0, []
    for i, h in enumerate(hashes):
        rolled = (rolled * BASE + h - (hashes[i - window] * gone if i >= window else 0)) % MODULUS
        if rolled % spacing == 0 or i + 1 == len(hashes):
            ends.append(i + 1)
    return ends


class Cutter:
    """Cuts a text into the passages that may be removed. A passage is numbered by its first line and its kind."""

    def __init__(self, window: int, spacing: int, min_lines: int, min_words: int, long_line: int):
        self.window, self.spacing, self.min_lines = window, spacing, min_lines
        self.min_words, self.long_line = min_words, long_line

    def __call__(self, text: str) -> tuple[list[bytes], int, dict[int, tuple[int, ...]]]:
        """The lines, the number of chunks, and by number the lines of each passage."""
        lines = text.encode().split(b"\n")
        ends = chunk_ends(lines, self.window, self.spacing)
        words = [len(x.split()) for x in lines]
        found = {}
        for a, b in zip([0, *ends], ends):
            if b - a >= self.min_lines and sum(map(bool, words[a:b])) >= self.min_lines:
                found[3 * a + COARSE] = tuple(range(a, b))
        full = [i for i, n in enumerate(words) if n]
        for a, b in zip(full, full[1:]):
            if words[a] + words[b] >= self.min_words:
                found[3 * a + FINE] = (a, b)
        for a in full:
            if words[a] >= self.long_line:
                found[3 * a + LINE] = (a,)
        return lines, len(ends), found


def body(lines: list[bytes], kind: int, places: tuple[int, ...]) -> bytes:
    """What is compared: passages of different kinds are never equal."""
    return b"%d" % kind + b"\n".join([lines[i] for i in places])


def digests_of(lines: list[bytes], found: dict[int, tuple[int, ...]]) -> np.ndarray:
    """Two 64-bit numbers for each passage."""
    data = b"".join(
        hashlib.md5(body(lines, number % 3, places), usedforsecurity=False).digest()
        for number, places in found.items()
    )
    return np.frombuffer(data, np.int64).reshape(-1, 2)


def all_digests(rows: DataFrame, cut: Cutter) -> DataFrame:
    """(h1, h2) of each passage of each document."""

    def start():
        def run(piece):
            out = [np.zeros((0, 2), np.int64)]
            for text in piece.column("text").to_pylist():
                if text:
                    lines, _, found = cut(text)
                    out.append(digests_of(lines, found))
            h = np.concatenate(out)
            return [np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1])]

        return run

    return map_slices(rows.select("text"), "h1 long, h2 long", start)


def bodies_of(rows: DataFrame, id_kind: str, cut: Cutter, repeated) -> DataFrame:
    """The bytes of passages whose digest may repeat: (doc_id, key, number, h1, h2, body)."""

    def start():
        def run(piece):
            cuts, digests = [], [np.zeros((0, 2), np.int64)]
            for doc, key, text in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                if text:
                    lines, _, found = cut(text)
                    cuts.append((doc, key, lines, found))
                    digests.append(digests_of(lines, found))
            digests = np.concatenate(digests)
            may = may_hold(repeated.value, np.ascontiguousarray(digests[:, 0]))
            owners = np.repeat(np.arange(len(cuts)), [len(found) for *_, found in cuts])[may].tolist()
            numbers = np.fromiter((n for *_, found in cuts for n in found), np.int64, len(may))[may].tolist()
            bodies = []
            for owner, number in zip(owners, numbers):
                _, _, lines, found = cuts[owner]
                bodies.append(body(lines, number % 3, found[number]))
            h1, h2 = np.ascontiguousarray(digests[may].T)
            return [[cuts[o][0] for o in owners], [cuts[o][1] for o in owners], numbers, h1, h2, bodies]

        return run

    return map_slices(rows, f"doc_id {id_kind}, key long, number long, h1 long, h2 long, body binary", start)


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, spacing: int = SPACING,
    min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, long_line: int = LONG_LINE, report: bool = False,
) -> DataFrame:
    """The documents without repeated passages; all columns kept.

    With ``report``, returns (doc_id, n_chunks, n_removed_chunks, n_removed_lines, text) instead: chunks of the coarse
    level, those of them that went, and all lines that went.

    Digests are counted in a narrow shuffle that combines map-side. A second scan ships the bytes of passages whose
    digest may repeat (by a Bloom filter of bounded size; one too many costs bytes only), which are compared with those
    of the first occurrence; a passage that merely shares a digest stays. Only documents that may lose a passage, by
    another such filter, move to meet the list of what they lose.
    """
    id_kind = id_type(docs, id_col)
    share = docs.sparkSession.sparkContext.broadcast
    cut = Cutter(window, spacing, min_lines, min_words, long_line)
    rows = whole_rows(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    narrow = rows.select("doc_id", "key", "text")

    repeated = all_digests(narrow, cut).groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1")
    repeated = share(hash_filter(staged(repeated, "repeated"), "h1"))
    bodies = staged(bodies_of(narrow, id_kind, cut, repeated), "bodies")
    first = bodies.groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "number", "body")).alias("first")
    )
    # Staged, so that the join below is one of two plain exchanges, where a hot digest is split.
    first = staged(first.where("n > 1").select("h1", "h2", "first"), "first")
    is_first = F.struct("doc_id", "key", "number").eqNullSafe(
        F.struct(*[F.col(f"first.{c}").alias(c) for c in ("doc_id", "key", "number")])
    )
    removed = (
        bodies.join(first, ["h1", "h2"]).where((F.col("body") == F.col("first.body")) & ~is_first)
        .groupBy(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key"))
        .agg(F.collect_set("number").alias("removed"))
    )
    removed = staged(removed.withColumn("r_doc", F.xxhash64("r_id", "r_key")), "removed")
    losing = share(hash_filter(removed.select("r_doc"), "r_doc"))
    rows = rows.withColumn("doc", F.xxhash64("doc_id", "key"))

    def rewritten(text, gone):
        if not text:
            return text, (0, 0, 0)
        lines, n_chunks, found = cut(text)
        if not gone:
            return text, (n_chunks, 0, 0)
        out = {i for number in set(gone) for i in found[number]}
        kept = b"\n".join([x for i, x in enumerate(lines) if i not in out]).decode()
        return kept, (n_chunks, sum(number % 3 == COARSE for number in set(gone)), len(out))

    head = "doc_id" if report else "row"
    if report:
        schema = parsed(f"doc_id {id_kind}, n_chunks long, n_removed_chunks long, n_removed_lines long, text string")
    else:
        schema = row_schema(rows, StructField("new_text", StringType()))

    def untouched():
        def run(piece):
            piece = piece.filter(pa.array(~may_hold(losing.value, piece.column("doc").to_numpy())))
            texts = piece.column("text")
            if not report:
                return [piece.column(head), texts]
            counts = [rewritten(t, None)[1] for t in texts.to_pylist()]
            return [piece.column(head), *([c[i] for c in counts] for i in range(3)), texts]

        return run

    def touched():
        def run(piece):
            piece = piece.filter(pa.array(may_hold(losing.value, piece.column("doc").to_numpy())))
            return [piece.column(c) for c in moving.names]

        return run

    def rewrite():
        def run(piece):
            done = [rewritten(*x) for x in zip(*(piece.column(c).to_pylist() for c in ("text", "removed")))]
            texts = [t for t, _ in done]
            counts = [[c[i] for _, c in done] for i in range(3)] if report else []
            return [piece.column(head), *counts, texts]

        return run

    moving = rows.select("doc_id", "key", "text", *([] if report else ["row"])).schema
    moved = map_slices(rows.select("doc_id", "key", "text", "doc", *([] if report else ["row"])), moving, touched)
    met = moved.join(
        removed, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left"
    )
    done = map_slices(rows.select(head, "text", "doc"), schema, untouched).unionByName(
        map_slices(met.select(head, "text", "removed"), schema, rewrite)
    )
    return done if report else with_new_text(done, docs.columns, text_col)

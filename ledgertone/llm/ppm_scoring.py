"""Language-model scores by prediction by partial matching, and by word counts, learned from the corpus itself.

The model is a trie over byte contexts of up to four bytes, with the counts of what follows. A byte unseen in the
longest context costs an escape (method C: the share of distinct followers among followers plus occurrences) and is
looked for in the next shorter one, from which the symbols already ruled out are excluded; below the empty context
all remaining symbols are equally likely. An end symbol follows each text; contexts at a text's start hold a start mark.

How it is spread out: documents are dealt into blocks of bounded bytes. Each block ships its distinct keys (five-symbol
windows and word hashes) with their training counts, not its occurrences, as compressed sorted runs. Windows meet where
all contexts with the same last three bytes do, and there get their code lengths; words meet by hash and get their
counts. The answers return to the blocks that asked, in the order of their keys, and each block scores its documents
from its own small table. Only counts for orders 0 to 2 are broadcast: their number
is bounded by the alphabet (257 * 258 * 258), whatever the corpus. Words are counted by 64-bit hash.

Results for unusual rows: null and empty texts are the end symbol alone. Repeated rows are learned from and scored each
for itself. A null id is passed through. With nothing to learn from, all symbols are equally likely. Other columns are
not read. Texts of any length are scored whole.
"""

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgertone.llm.batches import (
    block_runs, id_type, in_blocks, merged_blocks, packed, packed_plain, parsed, summed, unpacked_plain,
)
from ledgertone.llm.components import staged

ORDER = 4
END, START = 256, 257
SYMBOLS = 257
BITS = 9
GRAM, WORD = 0, 1
BLOCK_BYTES = 8 << 20
PART_BYTES = 16 << 20
_STEP_BYTES = 1 << 20
END_WORD = b""  # no word is empty


def lowered(text: str | None) -> bytes:
    return text.encode().lower() if text else b""


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all positions (last byte, the one before, ..., then the symbol itself; nine bits each), and how many
    positions each text has (its bytes and the end)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    x = np.full(int(lengths.sum()) + ORDER * len(texts), START, np.int64)
    at = 0
    for text, n in zip(texts, lengths.tolist()):
        at += ORDER
        x[at:at + n - 1] = np.frombuffer(text, np.uint8)
        x[at + n - 1] = END
        at += n
    keys = x[ORDER:].copy()
    for back in range(1, ORDER + 1):
        keys |= x[ORDER - back:len(x) - back] << (BITS * (ORDER + 1 - back))
    return keys[x[ORDER:] != START], lengths


def steps(texts: list[bytes]):
    """Runs of texts of about a megabyte, so that arrays stay small."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= _STEP_BYTES or i + 1 == len(texts):
            yield start, i + 1
            start, size = i + 1, 0


def distinct_keys(texts: list[bytes], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct window keys in order, with their counts in training texts."""
    keys, counts = [], []
    for a, b in steps(texts):
        own, lengths = windows(texts[a:b])
        codes, unique = pd.factorize(own)
        keys.append(unique)
        counts.append(np.bincount(codes, np.repeat(train[a:b], lengths), len(unique)))
    unique, codes = np.unique(np.concatenate(keys), return_inverse=True)
    return unique.view(np.uint64), np.bincount(codes, np.concatenate(counts), len(unique)).astype(np.int64)


def part_of(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """Where keys meet: windows by a hash of their last three bytes, words by their hash. Both keep to 64 bits."""
    if kind == GRAM:
        keys = (keys >> np.uint64(2 * BITS)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def by_part(kind: int, keys: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(part, places of its keys) for sorted keys, each part's places in order."""
    part = part_of(kind, keys, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    return [(int(part[order[a]]), order[a:b]) for a, b in zip(cuts, [*cuts[1:], len(order)])]


def word_keys(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def asked_keys(blocks: DataFrame, parts: int) -> DataFrame:
    """(kind, part, block, keys, counts): the distinct keys of each block, packed; counts are of training texts."""
    target = parsed("kind byte, part int, block long, keys binary, counts binary")

    def run(batches):
        fields = to_arrow_schema(target)
        for block, (texts, train) in block_runs(batches, "text", "train"):
            texts = [lowered(t) for t in texts]
            learned, asked = Counter(), set()
            for text, learn in zip(texts, train):
                (learned if learn else asked).update(text.split())
            learned[END_WORD] += sum(train)
            words = [*learned, *asked.difference(learned)]
            hashes, codes = np.unique(word_keys(words), return_inverse=True)
            n = np.bincount(codes, [learned[w] for w in words], len(hashes)).astype(np.int64)
            found = ((GRAM, *distinct_keys(texts, np.asarray(train, float))), (WORD, hashes, n))
            rows = [
                (kind, part, block, packed(keys[at]), packed_plain(counts[at]))
                for kind, keys, counts in found for part, at in by_part(kind, keys, parts)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return blocks.select("block", "text", "train").mapInArrow(run, target)


def totals(asked: DataFrame) -> DataFrame:
    """(key, n) of all windows cut to two bytes of context, beside (tokens, kinds) of words, part by part."""
    target = parsed("key long, n long, tokens long, kinds long")

    def count(group: pa.Table) -> pa.Table:
        keys, n, _ = summed(merged_blocks(group))
        keys, n = keys[n > 0].view(np.int64), n[n > 0]
        if group.column("kind")[0].as_py() == WORD:
            columns = [[None], [None], [int(n.sum())], [len(n)]]
        else:
            short, codes = np.unique((keys >> (3 * BITS) << BITS) | (keys & 511), return_inverse=True)
            sums = np.bincount(codes, n, len(short)).astype(np.int64)
            columns = [short, sums, [0] * len(short), [0] * len(short)]
        fields = to_arrow_schema(target)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    return asked.groupBy("kind", "part").applyInArrow(count, target)


def answers(asked: DataFrame, low) -> DataFrame:
    """(block, kind, part, values): code lengths of a block's windows and counts of its words, in the keys' order."""
    target = parsed("block long, kind byte, part int, values binary")

    def answer(group: pa.Table) -> pa.Table:
        kind, part = group.column("kind")[0].as_py(), group.column("part")[0].as_py()
        mine = merged_blocks(group)
        keys, n, codes = summed(mine)
        values = code_lengths(keys.view(np.int64), n, low.value) if kind == GRAM else n.astype(np.float64)
        at, rows = 0, []
        for block, (own, _) in mine.items():
            rows.append((block, kind, part, packed_plain(values[codes[at:at + len(own)]])))
            at += len(own)
        fields = to_arrow_schema(target)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    return asked.groupBy("kind", "part").applyInArrow(answer, target)


class LowOrders:
    """Counts after the empty context, one byte and two bytes, with what each context excludes from the next."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """keys: last byte, byte before, symbol; nine bits each, in order and distinct, with counts above 0."""
        self.tables = []  # by order: keys (context, symbol), counts, contexts, their totals and numbers of symbols
        for order in (2, 1, 0):
            symbol = keys & 511
            context = keys >> (BITS * (3 - order))
            own, codes = np.unique((context << BITS) | symbol, return_inverse=True)
            n = np.bincount(codes, counts, len(own))
            contexts, owner = np.unique(own >> BITS, return_inverse=True)
            total, distinct = np.bincount(owner, n, len(contexts)), np.bincount(owner, minlength=len(contexts))
            self.tables.insert(0, (own, n, contexts, total, distinct))

    def count(self, order: int, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        own, n = self.tables[order][:2]
        return _look(own, n, (context << BITS) | symbol)

    def totals(self, order: int, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, _, contexts, total, distinct = self.tables[order]
        return _look(contexts, total, context), _look(contexts, distinct, context)

    def excluded(self, order: int, context: np.ndarray) -> np.ndarray:
        """Occurrences, in the next shorter context, of the symbols seen in these contexts of ``order``."""
        own, _, contexts, _, _ = self.tables[order]
        shorter = self.count(order - 1, own >> BITS >> BITS, own & 511)
        owner = np.searchsorted(contexts, own >> BITS)
        return _look(contexts, np.bincount(owner, shorter, len(contexts)), context)


def _look(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Values of the asked keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0.0)


def code_lengths(keys: np.ndarray, n: np.ndarray, low: LowOrders) -> np.ndarray:
    """log10 of each window's probability. ``keys`` are distinct and hold all windows of their three-byte contexts."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order].astype(np.float64)
    symbol, four, three = keys & 511, keys >> BITS, keys >> (2 * BITS)
    seen = n > 0

    contexts4, own4 = np.unique(four, return_inverse=True)
    total4 = np.bincount(own4, n, len(contexts4))
    distinct4 = np.bincount(own4, seen, len(contexts4))

    pair = (three << BITS) | symbol
    pairs, own_pair = np.unique(pair, return_inverse=True)
    n3 = np.bincount(own_pair, n, len(pairs))
    contexts3, pair_owner = np.unique(pairs >> BITS, return_inverse=True)
    total3 = np.bincount(pair_owner, n3, len(contexts3))
    distinct3 = np.bincount(pair_owner, n3 > 0, len(contexts3))
    gone3 = np.bincount(own4, np.where(seen, n3[own_pair], 0.0), len(contexts4))
    n2_of_pair = low.count(2, pairs >> (2 * BITS), pairs & 511)
    gone2 = np.bincount(pair_owner, np.where(n3 > 0, n2_of_pair, 0.0), len(contexts3))
    own3 = pair_owner[own_pair]

    out = np.zeros(len(keys))
    left = np.ones(len(keys), bool)
    two, one = three >> BITS, three >> (2 * BITS)
    none = np.zeros(len(keys), np.int64)
    total2, distinct2 = low.totals(2, two)
    total1, distinct1 = low.totals(1, one)
    total0, distinct0 = low.totals(0, none)
    levels = (
        (n, total4[own4], distinct4[own4]),
        (n3[own_pair], total3[own3] - gone3[own4], distinct3[own3] - distinct4[own4]),
        (low.count(2, two, symbol), total2 - gone2[own3], distinct2 - distinct3[own3]),
        (low.count(1, one, symbol), total1 - low.excluded(2, two), distinct1 - distinct2),
        (low.count(0, none, symbol), total0 - low.excluded(1, one), distinct0 - distinct1),
    )
    with np.errstate(divide="ignore", invalid="ignore"):
        for count, total, distinct in levels:
            hit = left & (count > 0)
            out[hit] += np.log10(count[hit] / (total[hit] + distinct[hit]))
            left &= ~hit
            escape = left & (total > 0)
            out[escape] += np.log10(distinct[escape] / (total[escape] + distinct[escape]))
        out[left] -= np.log10(SYMBOLS - distinct0[left])
    result = np.empty(len(keys))
    result[order] = out
    return result


def ppm_scores(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: n_tokens, n_known, train_tokens, base_score and score (log10 of probabilities).

    Tokens are words (runs outside ASCII white space) and one end, of the text with A to Z in lower case. The base
    score smooths word counts by one half; ``score`` is the byte model's. ``train`` marks the rows to learn from (null:
    not).
    """
    spark = docs.sparkSession
    id_kind = id_type(docs, id_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )

    blocks = staged(in_blocks(rows, limit=BLOCK_BYTES), "blocks")
    size = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    asked = staged(asked_keys(blocks, parts), "asked")
    counted = staged(totals(asked), "totals")
    tokens, kinds = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    # Last byte, byte before, symbol: at most 258 * 258 * 257 rows.
    low = counted.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n")).toArrow().sort_by("key")
    low = LowOrders(low.column("key").to_numpy(), low.column("n").to_numpy())
    told = answers(asked, spark.sparkContext.broadcast(low))
    unit = np.log10(tokens + 0.5 * (kinds + 1))
    target = parsed(
        f"doc_id {id_kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

    def values_of(kind: int, keys: np.ndarray, table: pa.Table) -> np.ndarray:
        """The answers for the block's keys (sorted, distinct)."""
        rows = {
            part: data for k, part, data in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "values")))
            if k == kind
        }
        out = np.empty(len(keys))
        for part, at in by_part(kind, keys, parts):
            out[at] = unpacked_plain(rows[part], np.float64)
        return out

    def per_text(parts_of: list, kind: int, table: pa.Table):
        """From (codes, keys, lengths) of each run of texts: the answers of all its places, and where texts begin."""
        keys = np.unique(np.concatenate([k for _, k, _ in parts_of]))
        values = values_of(kind, keys, table)
        for codes, own, lengths in parts_of:
            yield values[np.searchsorted(keys, own)][codes], np.concatenate([[0], np.cumsum(lengths)[:-1]])

    def score(mine: pa.Table, table: pa.Table) -> pa.Table:
        texts = [lowered(t) for t in mine.column("text").to_pylist()]
        grams, words = [], []
        for a, b in steps(texts):
            own, lengths = windows(texts[a:b])
            codes, distinct = pd.factorize(own)
            grams.append((codes.astype(np.int32), distinct.view(np.uint64), lengths))
            lists = [[*t.split(), END_WORD] for t in texts[a:b]]
            flat = np.empty(sum(map(len, lists)), object)
            flat[:] = [w for ws in lists for w in ws]
            codes, distinct = pd.factorize(flat)
            words.append((codes.astype(np.int32), word_keys(distinct), np.array([len(ws) for ws in lists])))
        scores, base, known = [], [], []
        for values, starts in per_text(grams, GRAM, table):
            scores.append(np.add.reduceat(values, starts))
        for values, starts in per_text(words, WORD, table):
            base.append(np.add.reduceat(np.log10(values + 0.5) - unit, starts))
            known.append(np.add.reduceat((values > 0).astype(np.int64), starts))
        return pa.Table.from_arrays([
            mine.column("doc_id"), pa.array(np.concatenate([n for _, _, n in words]), pa.int64()),
            pa.array(np.concatenate(known), pa.int64()), pa.array([tokens] * len(texts), pa.int64()),
            pa.array(np.concatenate(base)), pa.array(np.concatenate(scores)),
        ], schema=to_arrow_schema(target))

    return blocks.select("block", "doc_id", "text").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        score, target
    )

"""Documents linked by the Jaccard similarity of their word shingles, found by a size-aware heavy-light join.

Two sets of n and m shingles link when they share at least t(n, m) of them. Light sets (few shingles) enumerate the
subsets of exactly that size, tagged with both sizes; a pair links only if a subset is equal. Heavy sets scan inverted
lists: shingles are ordered by how many documents hold them, rarest first, and a set only enters the lists of its first
n - t + 1 shingles, since a linked pair must meet in one of those. The boundary between light and heavy is the largest
size at which subsets cost less than lists, reckoned from the mean length of the lists. Light sets whose partners may
be heavy enter the lists as well. Shingles that only one document holds are in no subset and no list.

List lengths are counted exactly but for hash collisions, which only change the order and so the cost. Blocks of
documents ship their distinct shingle hashes as compressed runs to ranges of the hash space and get the counts back.

Documents with equal sets (by 128-bit hash) are one class and need one representative. Only connections are asked for, so the lists are
not expanded into all pairs: first each class is compared with one class that comes first in many of its lists; then,
in the lists that still hold several components, classes of different components are compared. A pair of which neither
step looks at is inside a component already, so no connection is lost. Each comparison is made on the texts.

Results for unusual rows: a null, empty or blank text has no shingles and links with nothing, not even its like. Fewer
words than ``size`` are one shingle. Repeated rows have the same set and so the same component. A null id is in the
component of its text; ``component_id`` is the smallest id that is not null, or null without one. Other columns are not
read. Ids are whole numbers.
"""

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgertone.llm.batches import (
    block_runs, handing_back, in_blocks, map_slices, merged_blocks, packed, packed_plain, parsed, return_memory, summed,
    whole_rows, with_new_text,
)
from ledgertone.llm.components import components, staged

SIZE = 5
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
LIGHT_LIMIT = 14  # the boundary is looked for up to this size; above, subsets never pay
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                np.uint64)


def multipliers(size: int) -> np.ndarray:
    """Odd numbers, one for each place in a shingle; beyond the given ones, by a rule."""
    more = [(int(_ODD[i % 5]) * (2 * i + 1)) % 2**64 | 1 for i in range(5, size)]
    return np.concatenate([_ODD[:size], np.array(more, np.uint64)])


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (lower-cased already)."""
    words = [t.split() for t in texts]
    lengths = [len(w) for w in words]
    flat = np.empty(sum(lengths), object)
    at = 0
    for w in words:
        flat[at:at + len(w)] = w
        at += len(w)
    codes, unique = pd.factorize(flat)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, unique), np.uint64, len(unique))[codes]
    rolled = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for i, m in enumerate(multipliers(size) if len(rolled) else ()):
        rolled += hashes[i:i + len(rolled)] * m
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    out, at = [], 0
    for n, w in zip(lengths, words):
        if n >= size:
            out.append(np.unique(rolled[at:at + n - size + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(b"\n".join(w), n)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def least_overlap(n: int, m: int, percent: int) -> int:
    """Smallest i with 100 * i >= percent * (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def partners(n: int, percent: int) -> range:
    """Sizes that a set of n can link with."""
    return range(-(-n * percent // 100), n * 100 // percent + 1)


def subset_cost(n: int, percent: int) -> int:
    return sum(comb(n, least_overlap(n, m, percent)) for m in partners(n, percent))


def prefix_length(n: int, percent: int) -> int:
    """How many of the rarest shingles must be listed: a partner shares at least percent * n / 100."""
    return n - -(-n * percent // 100) + 1


def boundary(mean_list: float, percent: int) -> int:
    """Largest size up to which enumerating subsets costs no more than scanning lists; 0 for none."""
    light = 0
    for n in range(1, LIGHT_LIMIT + 1):
        if subset_cost(n, percent) > prefix_length(n, percent) * mean_list:
            break
        light = n
    return light


def tokens(shared: np.ndarray, alone: int, light: int, percent: int) -> list[tuple[int, int]]:
    """(token, place) of a set: ``shared`` are its shingles that others hold too, rarest first, after ``alone`` others.

    Subset tokens have place -1. Tokens of lists and of subsets never meet, since subsets are hashed with their tags.
    """
    n = alone + len(shared)
    found = []
    if n <= light:
        own = sorted(shared.tolist())
        for m in partners(n, percent):
            t = least_overlap(n, m, percent)
            if m <= light and not (m == n and t == n):  # equal sets are one class already
                for part in combinations(own, t):
                    data = np.array(part, np.uint64).tobytes()
                    found.append((xxhash.xxh3_64_intdigest(data, min(n, m) << 8 | max(n, m)), -1))
    if n > light or partners(n, percent)[-1] > light:
        listed = max(0, prefix_length(n, percent) - alone)
        found += [(token, alone + i) for i, token in enumerate(shared[:listed].tolist())]
    return found


def _lower(texts: list) -> list[bytes]:
    return [t.encode().lower() if t else b"" for t in texts]


def _block_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Shingle sets of a block, made in runs of about a megabyte."""
    out, start, total = [], 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= 1 << 20 or i + 1 == len(texts):
            out += shingle_sets(texts[start:i + 1], size)
            start, total = i + 1, 0
    return out


def _keys(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Distinct hashes of a block, cut to the bits that are counted."""
    return np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - bits))


def shipped_runs(blocks: DataFrame, size: int, bits: int, range_bits: int) -> DataFrame:
    """(span, block, keys, counts): each block's shingle hashes with the number of its documents that hold them, by
    range of the hash space (its first bits). Ranges of which a block has nothing cost it nothing, so that rows never
    outnumber the hashes shipped."""
    target = parsed("span long, block long, keys binary, counts binary")

    def run(batches):
        fields = to_arrow_schema(target)
        for block, (texts,) in block_runs(batches, "text"):
            sets = _block_sets(_lower(texts), size)
            every = np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(64 - bits)
            keys, counts = np.unique(every, return_counts=True)
            spans, starts = np.unique(keys >> np.uint64(bits - range_bits), return_index=True)
            ends = np.append(starts[1:], len(keys))
            rows = [(int(i), block, packed(keys[a:b]), packed_plain(counts[a:b].astype(np.int64)))
                    for i, a, b in zip(spans, starts, ends)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields
                )

    return blocks.select("block", "text").mapInArrow(handing_back(run), target)


def list_lengths(runs: DataFrame) -> DataFrame:
    """(block, span, lengths, s1, s2): for each shipped run, in the order of its keys, how many documents hold each.

    One row of each range also has the sums of the lengths above 1 and of their squares.
    """
    target = parsed("block long, span long, lengths binary, s1 double, s2 double")

    def count(group: pa.Table) -> pa.Table:
        mine = merged_blocks(group)
        _, total, codes = summed(mine)
        long = total[total > 1].astype(float)
        sums = (float(long.sum()), float((long * long).sum()))
        total = np.minimum(total, 65535).astype(np.uint16)
        span, at, out = group.column("span")[0].as_py(), 0, []
        for block, (keys, _) in mine.items():
            out.append((block, span, zstandard.compress(total[codes[at:at + len(keys)]].tobytes(), 1), *sums))
            at, sums = at + len(keys), (0.0, 0.0)
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), to_arrow_schema(target))], schema=to_arrow_schema(target)
        )

    return runs.groupBy("span").applyInArrow(count, target)


SETS = "kind byte, doc_id long, key long, n int, sig long, sig2 long, text string, token long, place int"


def sets_and_tokens(
    blocks: DataFrame, lengths: DataFrame, size: int, percent: int, bits: int, light: int
) -> DataFrame:
    """Per document a row of kind 0 with its set's size and two hashes (and the text, if it has tokens), and a row of
    kind 1 for each token."""
    target = parsed(SETS)

    def make(mine: pa.Table, answers: pa.Table) -> pa.Table:
        fields = to_arrow_schema(target)
        ids, texts = mine.column("doc_id").to_pylist(), mine.column("text").to_pylist()
        sets = _block_sets(_lower(texts), size)
        keys = _keys(sets, bits)
        answers = answers.sort_by("span").column("lengths").to_pylist()
        held = np.concatenate(
            [np.frombuffer(zstandard.decompress(a), np.uint16) for a in answers] or [np.zeros(0, np.uint16)]
        )
        if len(held) != len(keys):
            raise RuntimeError("the counts do not belong to this block")
        sizes = [len(s) for s in sets]
        halves = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8").tolist() if len(s) else (None, None)
                  for s in sets]
        bodies, own, n, sig, token, place = [], [], [], [], [], []
        for doc, text, s, h in zip(ids, texts, sets, halves):
            found = []
            if len(s):
                many = held[np.searchsorted(keys, s >> np.uint64(64 - bits))]
                shared = s[many > 1]
                alone = len(s) - len(shared)
                if len(s) <= light or alone < prefix_length(len(s), percent):
                    shared = shared[np.lexsort((shared, many[many > 1]))]
                    found = tokens(shared, alone, light, percent)
            bodies.append(text if found else None)
            for t, p in found:
                own.append(doc)
                n.append(len(s))
                sig.append(h)
                token.append(t)
                place.append(p)
        a, b = len(ids), len(own)
        return pa.Table.from_arrays([
            pa.array([0] * a + [1] * b, pa.int8()), pa.array(ids + own, pa.int64()),
            pa.concat_arrays([*mine.column("key").chunks, pa.nulls(b, pa.int64())]), pa.array(sizes + n, pa.int32()),
            *(pa.array([h[i] for h in halves] + [h[i] for h in sig], pa.int64()) for i in (0, 1)),
            pa.array(bodies + [None] * b, pa.string()),
            pa.concat_arrays([pa.nulls(a, pa.int64()), pa.array(np.array(token, np.uint64).view(np.int64))]),
            pa.array([None] * a + place, pa.int32()),
        ], schema=fields)

    def made(mine: pa.Table, answers: pa.Table) -> pa.Table:
        rows = make(mine, answers)
        return_memory()
        return rows

    return blocks.select("block", "doc_id", "key", "text").groupBy("block").cogroup(
        lengths.select("block", "span", "lengths").groupBy("block")
    ).applyInArrow(made, target)


def told_apart(found: DataFrame) -> DataFrame:
    """The rows with one ``sig`` for each set. Sets are known by 128 bits; where two share the first 64, the others of
    them get a hash of both halves instead."""
    clashes = found.where("kind = 0").groupBy("sig").agg(F.min("sig2").alias("first"), F.max("sig2").alias("last"))
    clashes = staged(clashes.where("first <> last").select("sig", "first"), "clashes")
    if clashes.isEmpty():
        return found
    own = F.when(F.col("first") != F.col("sig2"), F.xxhash64("sig", "sig2")).otherwise(F.col("sig"))
    return found.join(clashes, "sig", "left").withColumn("sig", own).select(found.columns)


def similar(pairs: DataFrame, bodies: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose texts have shingle sets that link."""
    of_a = bodies.select(F.col("sig").alias("a"), F.col("text").alias("text_a"))
    of_b = bodies.select(F.col("sig").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")

    def start():
        def run(piece):
            a, b = piece.column("a").to_pylist(), piece.column("b").to_pylist()
            texts = dict(zip(a, piece.column("text_a").to_pylist())) | dict(zip(b, piece.column("text_b").to_pylist()))
            sets = dict(zip(texts, _block_sets(_lower(list(texts.values())), size)))
            good = []
            for i, (x, y) in enumerate(zip(a, b)):
                x, y = sets[x], sets[y]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    good.append(i)
            return [[a[i] for i in good], [b[i] for i in good]]

        return run

    return map_slices(both, "a long, b long", start, text="text_b")


def _sizes_fit(n, m, percent):
    return (n * 100 >= m * percent) & (m * 100 >= n * percent)


def first_pairs(members: DataFrame, percent: int) -> DataFrame:
    """For each class that is not first itself, the class that is first in most of its lists. First in a list is who
    has the fewest rarer shingles: an original, all of whose shingles its near copies hold, rather than a copy."""
    # Staged, so that the join is one of two plain exchanges, where a long list can be split over tasks.
    first = staged(members.groupBy("token").agg(F.min(F.struct("place", "sig", "n")).alias("first")), "first")
    met = members.join(first, "token").select(
        F.col("sig").alias("b"), "n", F.col("first.sig").alias("a"), F.col("first.n").alias("m")
    ).where(F.col("a") != F.col("b")).where(_sizes_fit(F.col("n"), F.col("m"), percent))
    times = met.groupBy("a", "b").agg(F.count("*").alias("times"))
    return times.groupBy("b").agg(F.max(F.struct("times", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def is_early(percent: int) -> Column:
    """Whether a set of n, met at this place, can still link with one that is no smaller. Members of a list that are
    too late for that meet only smaller partners; texts that share a template but are not alike are all too late, so
    that their lists, however long, make no pairs."""
    return (F.col("place") < 0) | ((F.col("n") - F.col("place")) * (100 + percent) >= F.col("n") * (2 * percent))


def crossing_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that meet in a list and may still be similar.

    In each list the component with most members is not paired with itself. Where a pair first meets, all it has in
    common lies from there on in both sets, so it meets only at places early enough; and its common shingles are at
    most those met in lists plus what follows the last of them in either set. The smaller set of a pair, or of equal
    ones that of the smaller hash, is taken from the early members only.
    """
    sizes = members.groupBy("token", "comp").agg(F.count("*").alias("k"), F.max(is_early(percent)).alias("early"))
    main = sizes.groupBy("token").agg(
        F.max(F.struct("k", "comp")).alias("main"), F.count("*").alias("c"), F.max("early").alias("early")
    )
    main = staged(main.where("c > 1 AND early").select("token", F.col("main.comp").alias("main")), "main")
    open_lists = staged(
        members.join(main, "token").withColumn("is_main", F.col("comp") == F.col("main")).drop("main"), "open_lists"
    )
    small = open_lists.where(is_early(percent)).select(
        "token", F.col("sig").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("comp").alias("ca"),
        "is_main",
    )
    large = open_lists.select(
        "token", F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("comp").alias("cb"),
        F.col("is_main").alias("b_main"),
    )
    after = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    enough = after * (100 + percent) >= percent * (F.col("na") + F.col("nb"))
    pair = (
        (F.col("ca") != F.col("cb"))
        & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
        & _sizes_fit(F.col("na"), F.col("nb"), percent) & ((F.col("pa") < 0) | enough)
    )
    # Main members meet the others only, from either side.
    met = small.where("NOT is_main").drop("is_main").join(large.drop("b_main"), "token").where(pair).unionByName(
        small.where("is_main").drop("is_main").join(large.where("NOT b_main").drop("b_main"), "token").where(pair)
    )
    met = met.groupBy("a", "b", "na", "nb").agg(
        F.count_if(F.col("pa") >= 0).alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.min("pa").alias("least"),
    )
    most = F.col("c") + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    need = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    return met.where((F.col("least") < 0) | (most >= need)).select("a", "b")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = 80,
) -> DataFrame:
    """One row per document: doc_id, text_key (hash of the text), n_shingles, class_id (hash of its set; null without
    shingles), group_id (one class of its component) and component_id.

    Documents whose shingle sets have at least ``percent`` percent of their union in common are linked; a component is
    what links connect. Texts are lower-cased (A to Z) first.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("key"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(32, min(48, total.bit_length() + 5))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_BYTES)
    range_bits = min(bits, max(0, ranges - 1).bit_length())

    blocks = staged(in_blocks(rows, limit=BLOCK_BYTES), "blocks")
    lengths = staged(list_lengths(shipped_runs(blocks, size, bits, range_bits)), "lengths")
    s1, s2 = lengths.agg(F.coalesce(F.sum("s1"), F.lit(0.0)), F.coalesce(F.sum("s2"), F.lit(0.0))).first()
    light = boundary(s2 / s1 if s1 else 0.0, percent)
    found = told_apart(staged(sets_and_tokens(blocks, lengths, size, percent, bits, light), "sets"))
    sets = found.where("kind = 0").select("doc_id", "key", "n", "sig")

    members = found.where("kind = 1").select("token", "sig", "n", "place")
    lists = members.groupBy("token").agg(
        F.min("sig").alias("lo"), F.max("sig").alias("hi"), F.max(is_early(percent)).alias("early")
    ).where("lo <> hi AND early")
    lists = staged(lists.select("token"), "lists")
    members = staged(members.join(lists, "token").distinct(), "members")
    # One text of each class; combined map-side first, so that a class with very many copies ships one a task.
    bodies = found.where("kind = 0 AND text IS NOT NULL").groupBy("sig").agg(F.any_value("text").alias("text"))
    bodies = staged(bodies.join(members.select("sig").distinct(), "sig", "left_semi"), "bodies")

    label = components(similar(first_pairs(members, percent), bodies, size, percent))
    placed = members.join(label.withColumnRenamed("node", "sig"), "sig", "left").select(
        "token", "sig", "n", "place", F.coalesce("label", "sig").alias("comp")
    )
    more = similar(crossing_pairs(placed, percent), bodies, size, percent)
    of = label.select(F.col("node").alias("sig"), "label")
    edges = more.join(of.select(F.col("sig").alias("a"), F.col("label").alias("la")), "a", "left").join(
        of.select(F.col("sig").alias("b"), F.col("label").alias("lb")), "b", "left"
    ).select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    merged = components(edges).select(F.col("node").alias("comp"), F.col("label").alias("top"))

    comp = sets.join(of, "sig", "left").withColumn("comp", F.coalesce("label", "sig")).drop("label")
    comp = comp.join(merged, "comp", "left").withColumn("comp", F.coalesce("top", "comp")).drop("top")
    alone = F.col("n") == 0
    comp = staged(comp, "comp")
    smallest = staged(comp.where(~alone).groupBy("comp").agg(F.min("doc_id").alias("smallest")), "smallest")
    return comp.join(smallest, "comp", "left").select(
        "doc_id", F.col("key").alias("text_key"), F.col("n").cast("long").alias("n_shingles"),
        F.col("sig").alias("class_id"), F.col("comp").alias("group_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = 80,
) -> DataFrame:
    """The documents, all columns, without those linked to one that stays: of each component the smallest id (a null
    id only if there is no other), and among rows that share it the smallest hash of the text. Documents without
    shingles stay. Rows that repeat an id and its text count as one document."""
    found = jaccard_components(docs, id_col, text_col, size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    linked = found.where("n_shingles > 0").groupBy("group_id").agg(F.min(order).alias("first")).select("first.*")
    stays = linked.select("doc_id", "text_key").unionByName(
        found.where("n_shingles = 0").select("doc_id", "text_key").distinct()
    )
    # Two independent hashes of id and text stand for a row in one equality without nulls.
    rows = whole_rows(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))

    def named(df):
        key = (F.col("doc_id").cast("long"), F.col("text_key"))
        return df.withColumn("k1", F.xxhash64(*key)).withColumn("k2", F.hash(F.lit(7), *key))

    kept = named(rows).join(named(stays).select("k1", "k2"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return with_new_text(kept.select("row", F.col("text").alias("new_text")), docs.columns, text_col)

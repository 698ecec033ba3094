"""Exact splits, samples and caps without a global sort in one task.

A positional split only needs the rows at its cut positions, not everybody's rank. The cuts are found
on key columns alone; every row is then placed by comparing its own key with them, so the wide rows
are neither shuffled nor sorted.
"""

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.functions.text import seeded_hash
from ledgertone.schemas import LABELS, SPLITS
from ledgertone.session import cut_lineage, small_side, stage

Cuts = Callable[[Column], list[Column]]
TIE = "_tie"


def with_tie(df: DataFrame) -> DataFrame:
    """The rows with a number of their own, written once, so that a lost executor cannot number them anew."""
    return stage(df.withColumn(TIE, F.monotonically_increasing_id()), "numbered")


def with_place(df: DataFrame) -> tuple[DataFrame, bool]:
    """Adds each row's place in the input, and tells whether another read gives it the same one.

    Files follow by path and rows as they stand in them, however Spark packs files into tasks. Formats that number their
    rows (Parquet) give a fixed place; of others the rows of a file's range are numbered as they are read. A frame that
    does not come straight from files is taken as it lies.
    """
    path, block = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    number = F.monotonically_increasing_id().alias("number")
    for place, fixed in (
        (F.struct(path, F.col("_metadata.row_index").alias("row")), True), (F.struct(path, block, number), False),
    ):
        try:
            return df.withColumn(TIE, place), fixed
        except AnalysisException:  # no such metadata
            continue
    return df.withColumn(TIE, number), False


def split_cuts(total: Column) -> list[Column]:
    """End positions of train and validation: test and validation are round(0.2 n), train the rest."""
    fifth = F.round(total * F.lit(0.2)).cast("bigint")
    return [total - fifth - fifth, total - fifth]


def _place(df: DataFrame, groups: list[str], cuts: DataFrame, order: Column, names: list[str]) -> DataFrame:
    """Adds ``_segment``: the number of cuts a row lies beyond. Groups compare null-safe."""
    side = small_side(cuts.select(*[F.col(g).alias(f"_g_{g}") for g in groups], *names))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    joined = df.withColumn("_order", order).join(side, same, "left")
    beyond = [(~F.coalesce(F.col("_order") <= F.col(n), F.lit(False))).cast("int") for n in names]
    segment = beyond[0]
    for flag in beyond[1:]:
        segment = segment + flag
    return joined.withColumn("_segment", segment).drop("_order", *[f"_g_{g}" for g in groups], *names)


def _hash_cuts(df: DataFrame, groups: list[str], hashed: Column, cuts: Cuts) -> tuple[DataFrame, list[str]]:
    """Per group the hash at each cut position (``_cut0``, ...), and how many rows of that very hash lie at or
    before the position (``_take0``, ...).

    A hash is uniform, so a histogram over its first 16 bits (at most 65,536 rows per group, combined
    map-side) tells in which bucket a cut falls; only those buckets are looked at more closely.
    """
    keys = df.select(*groups, hashed.alias("_h")).withColumn("_bucket", F.substring("_h", 1, 4))
    histogram = keys.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*groups).orderBy("_bucket"))
    total = F.sum("_n").over(W.partitionBy(*groups))
    sized = histogram.withColumns({"_upto": upto, "_total": total})
    positions = cuts(F.col("_total"))
    names = [f"_cut{i}" for i in range(len(positions))]
    edges = sized.withColumn(
        "_edge",
        F.explode(F.array(*[F.struct(F.lit(n).alias("cut"), p.alias("pos")) for n, p in zip(names, positions)])),
    ).where((F.col("_upto") - F.col("_n") < F.col("_edge.pos")) & (F.col("_edge.pos") <= F.col("_upto")))
    edges = edges.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups], F.col("_bucket").alias("_b"), F.col("_edge.cut").alias("_cut"),
        (F.col("_edge.pos") - (F.col("_upto") - F.col("_n"))).alias("_need"),
    )
    same = F.col("_bucket") == F.col("_b")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = keys.join(small_side(edges), same).groupBy(*groups, "_cut", "_need", "_h").agg(
        F.count("*").alias("_n")
    )
    reached = F.sum("_n").over(W.partitionBy(*groups, "_cut").orderBy("_h"))
    at_cut = inside.withColumn("_reached", reached).where(F.col("_reached") >= F.col("_need"))
    take = F.col("_need") - (F.col("_reached") - F.col("_n"))
    of = {n: F.when(F.col("_cut") == n, F.col("_h")) for n in names}
    found = at_cut.groupBy(*groups).agg(
        *[F.min(h).alias(n) for n, h in of.items()],
        *[F.min_by(take, h).alias(n.replace("cut", "take")) for n, h in of.items()],
    )
    return found, names


def hash_segments(df: DataFrame, groups: Sequence[str], hashed: Column, cuts: Cuts) -> DataFrame:
    """Adds ``_segment`` by position in hash order within each group. Copies of a key share a hash and therefore a
    segment, which moves as a block: the sizes are exact where the key is unique."""
    groups = list(groups) or ["_all"]
    if groups == ["_all"]:
        df = df.withColumn("_all", F.lit(0))
    found, names = _hash_cuts(df, groups, hashed, cuts)
    return _place(df, groups, found, hashed, names).drop("_all")


def distributed_rank(
    keys: DataFrame, order: Sequence[str], groups: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Adds ``rank`` (1..n within each group) by the given order, equal to a row_number window.

    Range partitions are sorted locally, then numbered from the sizes of the partitions before them,
    so no group meets in one task. The sorted rows are checkpointed: their partition numbers must not
    change when an executor is lost. Pass narrow rows.
    """
    by = [*groups, *order]
    spread = keys.repartitionByRange(partitions, *by) if partitions else keys.repartitionByRange(*by)
    ranged = cut_lineage(
        spread.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    ).withColumns(
        {"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = ranged.groupBy("_part", *groups).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*(groups or [F.lit(0)])).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in groups], "_first", "_before"
    )
    same = F.col("_part") == F.col("_p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    ranked = ranged.join(small_side(offsets), same)
    return ranked.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first") + 1).drop(
        "_id", "_part", "_at", "_p", "_first", "_before", "_n", *[f"_g_{g}" for g in groups]
    )


def _named(segment: Column) -> Column:
    chain = F
    for number, name in enumerate(SPLITS[:-1]):
        chain = chain.when(segment == number, F.lit(name))
    return chain.otherwise(F.lit(SPLITS[-1]))


def sequential_split(
    df: DataFrame, order: Sequence[str], group: str = "dataset_label", split: str = "split", unique: bool = False
) -> DataFrame:
    """60/20/20 by position, given splits in the order train, validation, test, then any others by name.

    Rows with equal order keys, or all rows of a given split without any, follow in the order in which the input
    lies (``with_place``). Where that place is not the same on every read, the rows are written once. Only keys are
    ranked. A caller whose order keys are ``unique`` within a group needs no place.
    """
    if not unique:
        df, fixed = with_place(df)
        df = df if fixed else stage(df, "numbered")
    given = F
    for number, name in enumerate(SPLITS):
        given = given.when(F.col(split) == name, F.lit(number))
    place = F.struct(
        given.otherwise(F.lit(len(SPLITS))).alias("p"), F.coalesce(F.col(split), F.lit("")).alias("s"),
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(order if unique else [*order, TIE])],
    )
    keys = df.select(group, place.alias("_place"))
    ranked = distributed_rank(keys, ["_place"], [group])
    # Ranked rows are on disk already; the sizes come from them rather than from the input.
    totals = ranked.groupBy(group).agg(F.count("*").alias("_total"))
    first, second = split_cuts(F.col("_total"))
    ends = totals.select(F.col(group).alias("_g"), first.alias("_e0"), second.alias("_e1"))
    at_end = ranked.join(small_side(ends), F.col(group).eqNullSafe(F.col("_g"))).where(
        (F.col("rank") == F.col("_e0")) | (F.col("rank") == F.col("_e1"))
    )
    found = at_end.groupBy(group).agg(
        *[F.max(F.when(F.col("rank") == F.col(f"_e{i}"), F.col("_place"))).alias(f"_cut{i}") for i in range(2)]
    )
    placed = _place(df, [group], found, place, ["_cut0", "_cut1"])
    return placed.withColumn(split, _named(F.col("_segment"))).drop("_segment", TIE)


def shuffled_split(
    df: DataFrame, key: str, group: str = "dataset_label", seed: int = 42, split: str = "split"
) -> DataFrame:
    """60/20/20 per dataset in a seeded random order of the key.

    Rows that share a key stay together, so a text with many copies can shift the shares by its own; with a unique
    key they are exact.
    """
    placed = hash_segments(df, [group], seeded_hash(seed, key), split_cuts)
    return placed.withColumn(split, _named(F.col("_segment"))).drop("_segment")


def stratified_split(
    df: DataFrame, key: str, label: str = "label_normalized", seed: int = 42, split: str = "split",
    min_rows: int = 0, min_per_class: int = 0,
) -> DataFrame:
    """60/20/20 per label.

    On request: all train below ``min_rows`` rows, and one split over all labels if there is one label only or one
    with fewer than ``min_per_class`` rows.
    """
    rows = df.where(F.col("text").isNotNull() & (F.length("text") > 0) & F.col(label).isin(*LABELS))
    if not (min_rows or min_per_class):
        placed = hash_segments(rows, [label], seeded_hash(seed, key), split_cuts)
        return placed.withColumn(split, _named(F.col("_segment"))).drop("_segment")
    # At most three rows come back: one count per label.
    counts = [r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()]
    if sum(counts) < min_rows:
        return rows.withColumn(split, F.lit(SPLITS[0]))
    stratify = len(counts) > 1 and min(counts) >= min_per_class
    placed = hash_segments(rows, [label] if stratify else [], seeded_hash(seed, key), split_cuts)
    return placed.withColumn(split, _named(F.col("_segment"))).drop("_segment")


def take_per_group(df: DataFrame, groups: Sequence[str], count: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``count`` rows of each group, or all if it has fewer, by seeded hash of the key.

    The cut is found on keys alone; rows beyond it are dropped where they are read. Only rows that share the key at the
    cut are ordered by their whole content; those equal in every column are copies, of which the right number is made.
    """
    groups = list(groups)
    rows = df.withColumn("_o", seeded_hash(seed, key))
    found, _ = _hash_cuts(rows, groups, F.col("_o"), lambda total: [F.least(total, F.lit(count).cast("bigint"))])
    near = stage(_up_to_cut(rows, groups, found, "_o"), "near")
    before = near.where(F.col("_o") < F.col("_cut0")).select(*df.columns)
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    at_cut = near.where(F.col("_o") == F.col("_cut0")).withColumn("_o", whole)
    at_cut = at_cut.withColumnRenamed("_take0", "_wanted").drop("_cut0")
    wanted = [*groups, "_wanted"]
    found, _ = _hash_cuts(at_cut, wanted, F.col("_o"), lambda total: [F.least(total, F.col("_wanted"))])
    last = _up_to_cut(at_cut, wanted, found, "_o")
    ends = last.where(F.col("_o") == F.col("_cut0")).groupBy(*df.columns).agg(F.max("_take0").alias("_n"))
    copies = ends.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    inner = last.where(F.col("_o") < F.col("_cut0")).select(*df.columns)
    return before.unionByName(inner).unionByName(copies.select(*df.columns))


def _up_to_cut(rows: DataFrame, groups: list[str], found: DataFrame, order: str) -> DataFrame:
    """The rows up to their group's cut, with ``_cut0`` and ``_take0``. Groups compare null-safe."""
    side = small_side(found.select(*[F.col(g).alias(f"_g_{g}") for g in groups], "_cut0", "_take0"))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return rows.join(side, same).where(F.col(order) <= F.col("_cut0")).drop(*[f"_g_{g}" for g in groups])


def stratified_sample(
    df: DataFrame, per_class: int, key: str, label: str = "label_normalized", seed: int = 42
) -> DataFrame:
    return take_per_group(df, [label], per_class, key, seed)


def cap_split_rows(df: DataFrame, split_name: str, max_rows: int, key: str, seed: int = 42) -> DataFrame:
    """At most ``max_rows`` rows of one split, the others untouched; 0 or less means no cap."""
    if max_rows <= 0:
        return df
    in_split = F.col("split").eqNullSafe(F.lit(split_name))
    return df.where(~in_split).unionByName(take_per_group(df.where(in_split), ["split"], max_rows, key, seed))

"""The most frequent words and word pairs, overall or by group, found without shuffling every one of them.

Each task keeps for each group a summary of at most ``tracked`` terms: when more have come together, all counts are lowered
by the largest one that must go. A term's true count then exceeds what the merged summaries say by no more than the sum of
what the tasks took off. Terms that can reach the last place by that bound are counted again, exactly, in a second pass.
Where a term in no summary could reach it, all terms of that group are counted instead, so the result is exact in any case.

A task's memory does not grow with its rows: texts are taken in slices of bounded words (a longer text is a slice of its
own), and the groups that a task meets share the terms that it tracks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgertone.session import BROADCAST_BYTES, cut_lineage, stage

TRACKED, CANDIDATES = 400_000, 1_000_000
LEAST_TRACKED = 10_000  # of a group, however many share
_SLICE_ROWS, _SLICE_WORDS, _SENT_ROWS = 2_000, 200_000, 50_000
_COUNTS = "grp string, term string, total long, df long"


def grams(words: pa.ListArray, orders: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, text of each occurrence, term of each occurrence) of words and, with ``orders`` 2, of pairs of
    neighbours, spelled with a blank between. Only distinct pairs are spelled."""
    flat = words.flatten()
    owner = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy())
    if flat.null_count:
        owner, flat = owner[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
    coded = flat.dictionary_encode()
    names, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    if orders == 1 or len(index) < 2:
        return names, owner, index
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    pairs, codes = np.unique(index[inside] * len(names) + index[inside + 1], return_inverse=True)
    first, second = np.divmod(pairs, len(names))
    spelled = pc.binary_join_element_wise(names.take(pa.array(first)), names.take(pa.array(second)), " ")
    return (
        pa.concat_arrays([names, spelled]), np.concatenate([owner, owner[inside]]),
        np.concatenate([index, codes + len(names)]),
    )


class Summary:
    """Terms with counts, at most ``size`` after each reduction; ``error`` bounds what any count has lost."""

    def __init__(self, size: int):
        self.size, self.error, self._parts, self._held = size, 0, [], 0

    def add(self, terms: pa.Array, counts: np.ndarray) -> None:
        self._parts.append(pa.table({"term": terms, "n": counts}))
        self._held += len(terms)
        if self._held > 2 * self.size:
            self.reduce()

    def reduce(self) -> pa.Table:
        if not self._parts:
            return pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        table = pa.concat_tables(self._parts).group_by("term").aggregate([("n", "sum")])
        table = table.rename_columns({"n_sum": "n"}).select(["term", "n"])
        if len(table) > self.size:
            counts = table.column("n").to_numpy()
            taken = int(np.partition(counts, -(self.size + 1))[-(self.size + 1)])
            self.error += taken
            lower = counts - taken
            table = pa.table({"term": table.column("term"), "n": lower}).filter(pa.array(lower > 0))
        self._parts, self._held = [table], len(table)
        return table


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts batches, whose second column are lists of words, after so many rows or words."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + _SLICE_WORDS, side="right"))
            stop = min(max(stop, start + 1), start + _SLICE_ROWS)
            yield batch.slice(start, stop - start)
            start = stop


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.ListArray]]:
    for batch in slices(batches):
        groups, words = batch.column(0), batch.column(1)
        for group in groups.unique().to_pylist():
            yield group, words.filter(pc.equal(groups, group))


def _summarized(orders: int, tracked: int):
    """A row per term that a task tracks, and for each group one without a term that tells the error."""

    nothing = pa.array([], pa.string()), np.array([], np.int64)

    def run(batches):
        kept: dict[str, Summary] = {}
        for group, words in _by_group(batches):
            terms, _, index = grams(words, orders)
            if not len(terms):
                continue
            if group not in kept:
                kept[group] = Summary(tracked)
                for summary in kept.values():
                    summary.size = max(tracked // len(kept), min(tracked, LEAST_TRACKED))
                    summary.add(*nothing)
            kept[group].add(terms.cast(pa.string()), np.bincount(index, minlength=len(terms)))
        for group in list(kept):
            summary = kept.pop(group)
            table = summary.reduce()
            terms = table.column("term").combine_chunks().cast(pa.string())
            terms = pa.concat_arrays([terms, pa.array([None], pa.string())])
            counts = np.append(table.column("n").to_numpy(), summary.error)
            for at in range(0, len(terms), _SENT_ROWS):
                part = terms.slice(at, _SENT_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group] * len(part)), part, pa.array(counts[at:at + _SENT_ROWS], pa.int64())],
                    ["grp", "term", "n"])
        pa.default_memory_pool().release_unused()

    return run


def _counted(orders: int, candidates: dict[str, pa.Array] | None):
    """Total and document frequency: of the candidates only, one row each and task, or of all terms, a row each slice."""

    def rows(group, terms, total, documents):
        return pa.RecordBatch.from_arrays(
            [pa.array([group] * len(terms), pa.string()), terms.cast(pa.string()), pa.array(total), pa.array(documents)],
            ["grp", "term", "total", "df"],
        )

    def run(batches):
        known = candidates or {}
        sums = {g: (np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)) for g, c in known.items()}
        for group, words in _by_group(batches):
            if candidates is not None and group not in known:
                continue
            terms, owner, index = grams(words, orders)
            size = len(terms)
            if candidates is not None:
                size = len(known[group])
                found = pc.index_in(terms.cast(pa.string()), value_set=known[group])
                place = pc.fill_null(found, -1).to_numpy()[index]
                index, owner = place[place >= 0], owner[place >= 0]
            once = np.unique(index * len(words) + owner) // max(len(words), 1)
            here = np.bincount(index, minlength=size), np.bincount(once, minlength=size)
            if candidates is None:
                yield rows(group, terms, *here)
            else:
                for total, more in zip(sums[group], here):
                    total += more
        for group, (total, documents) in sums.items():
            seen = np.flatnonzero(total)
            yield rows(group, known[group].take(pa.array(seen)), total[seen], documents[seen])

    return run


def top_grams(
    df: DataFrame, words: Column, size: int, orders: int = 1, tracked: int = TRACKED, most_candidates: int = CANDIDATES,
    by: str | None = None,
) -> DataFrame:
    """(term, total, df): the ``size`` most frequent terms, equally frequent ones by name, with the number of rows that
    hold each. ``words`` is an array of strings; ``orders`` 2 adds pairs of neighbours.

    With ``by``, the most frequent ones of each value of that column, which comes first in the result, as a string; there
    should be few values, since a task keeps a summary for each that it meets. Null is a value of its own.
    """
    marked = F.lit("1") if by is None else F.coalesce(F.concat(F.lit("1"), F.col(by).cast("string")), F.lit("0"))
    lists = df.select(marked.alias("grp"), words.alias("words"))

    def counted(rows, candidates):
        found = rows.mapInArrow(_counted(orders, candidates), _COUNTS)
        totals = found.groupBy("grp", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
        if by is None:
            return totals.orderBy(F.col("total").desc(), "term").limit(size)
        order = W.partitionBy("grp").orderBy(F.col("total").desc(), "term")
        return totals.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= size).drop("_rn")

    candidates, errors = candidate_terms(lists, size, orders, tracked, most_candidates)
    top = cut_lineage(counted(lists, candidates))
    last = {r["grp"]: r for r in top.groupBy("grp").agg(
        F.count("*").alias("rows"), F.min("total").alias("total")).collect()}  # a row per group
    unproved = [
        g for g, error in errors.items()
        if g not in candidates or (error and (g not in last or last[g]["rows"] < size or last[g]["total"] <= error))
    ]
    if unproved:
        rest = counted(lists.where(F.col("grp").isin(unproved)), None)
        top = top.where(~F.col("grp").isin(unproved)).unionByName(rest)
    if by is None:
        return top.select("term", "total", "df")
    return top.select(F.expr("IF(grp = '0', NULL, substr(grp, 2))").alias(by), "term", "total", "df")


def candidate_terms(
    lists: DataFrame, size: int, orders: int, tracked: int, most: int
) -> tuple[dict[str, pa.Array], dict[str, int]]:
    """By group: terms that can be among the ``size`` most frequent, and how often a term in no summary can occur at most.
    A group for which that cannot be settled has no terms here; if there are more than ``most`` terms in all, or they are
    too long to send to every task, no group has."""
    summaries = lists.mapInArrow(_summarized(orders, tracked), "grp string, term string, n long")
    held = stage(summaries.groupBy("grp", "term").agg(F.sum("n").alias("n")), "summaries")
    errors = {r["grp"]: r["n"] for r in held.where("term IS NULL").collect()}  # a row per group
    told = held.where("term IS NOT NULL")
    order = W.partitionBy("grp").orderBy(F.col("n").desc(), "term")
    best = told.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= size)
    least = {}
    for r in best.groupBy("grp").agg(F.min("n").alias("n"), F.count("*").alias("k")).collect():
        error = errors[r["grp"]]
        if r["k"] < size:
            if not error:
                least[r["grp"]] = 0
        elif not error or r["n"] > error:
            least[r["grp"]] = r["n"] - error
    if not least:
        return {}, errors
    bounds = lists.sparkSession.createDataFrame(list(least.items()), "g string, least long")
    near = told.join(F.broadcast(bounds), F.col("grp") == F.col("g")).where(F.col("n") >= F.col("least"))
    found = near.select("grp", "term").limit(most + 1).toArrow()
    if len(found) > most or found.nbytes > BROADCAST_BYTES:
        return {}, errors
    return {
        g: found.filter(pc.equal(found.column("grp"), g)).column("term").combine_chunks().cast(pa.string()) for g in least
    }, errors

"""Ingest, bronze, silver and gold jobs. Operators build plans; the jobs own every write and every log row."""

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgertone.functions.text import record_hash
from ledgertone.operators import medallion as M
from ledgertone.operators import quality as K
from ledgertone.operators import reports as R
from ledgertone.operators import splits as P
from ledgertone.operators.dedup import keep_first
from ledgertone.schemas import CANONICAL_BATCH, CONTROL_TABLES, LABELS, SPLITS
from ledgertone.session import path_exists, scratch_path, scratch_scope, stage
from ledgertone.sinks import tables as W
from ledgertone.sources import readers as S
from ledgertone.sources.columns import union_by_name
from ledgertone.sources.specs import SourceSpec, canonical_valid, standardize


@dataclass(frozen=True)
class Workspace:
    """Where a pipeline keeps its files and tables."""

    root: str
    database: str

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @property
    def canonical(self) -> str:
        return f"{self.root}/canonical"


def bootstrap(spark: SparkSession, space: Workspace) -> list[str]:
    return W.registry_tables(spark, space.database)


def _log(spark, space, run_id, step, status, message, rows):
    W.append_run_log(spark, space.table("pipeline_run_log"), run_id, step, status, message, rows)


def _split_union(splits: Mapping[str, DataFrame]) -> DataFrame:
    """The given splits of one source under each other, known names first."""
    names = [s for s in SPLITS if s in splits] + [s for s in splits if s not in SPLITS]
    return union_by_name([splits[name].withColumn("given_split", F.lit(name)) for name in names])


def ingest_source(
    spark: SparkSession, space: Workspace, spec: SourceSpec, splits: Mapping[str, DataFrame], batch_id: str,
    order: Sequence[str] = (), seed: int | None = 42,
) -> Iterator[dict]:
    """Raw snapshot per given split, then the canonical table with 60/20/20 splits.

    Yields a manifest row after each write, so that what was saved before a failure stays on record.

    With a seed rows are drawn by a hash of their content, so copies share a split (and move as a block: a text with
    very many copies shifts 60/20/20 by its own). Without one the split is positional in the order of the ``order``
    columns, then in that of the files. What is staged on the way is removed at the end.
    """
    with scratch_scope(spark):
        yield from _ingest_source(spark, space, spec, splits, batch_id, order, seed)


def _ingest_source(spark, space, spec, splits, batch_id, order, seed) -> Iterator[dict]:
    for name, frame in splits.items():
        path = f"{space.root}/raw/{spec.source_platform}/{spec.key}/{name}"
        counted = Observation()
        W.write_raw_snapshot(frame.observe(counted, F.count(F.lit(1)).alias("rows")), path)
        yield {
            "status": "raw_parquet_saved", "split_name": name, "rows_written": counted.get["rows"],
            "raw_parquet_path": path,
        }
    raw = _split_union(splits)
    if seed is None:
        placed = P.sequential_split(
            raw.withColumn("_source", F.lit(spec.key)), order, group="_source", split="given_split"
        )
    else:
        content = [c for c in raw.columns if c != "given_split"]
        keyed = raw.withColumns({"_key": record_hash(*[F.col(f"`{c}`") for c in content]), "_source": F.lit(spec.key)})
        placed = P.shuffled_split(stage(keyed, spec.key), "_key", "_source", seed, split="given_split")
    rows = canonical_valid(standardize(placed, spec, F.col("given_split")))
    rows = rows.withColumns(
        {
            "download_batch_id": F.lit(batch_id),
            "source_record_hash": record_hash("dataset_label", "split", "text", "label_normalized"),
        }
    )
    counted, path = Observation(), f"{space.canonical}/{spec.key}"
    # Rows of one hash agree in every column, so any order picks the same row.
    unique = keep_first(rows, ["source_record_hash"], ["split"])
    unique.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    saved = {"status": "canonical_parquet_saved", "canonical_parquet_path": path}
    # Rows by split and label, for the manifest: a handful of rows, read back from the table.
    written = spark.read.schema(unique.schema).parquet(path)
    for row in R.split_label_counts(written).collect():
        counts = json.dumps(dict(sorted((k or "missing", n) for k, n in row["labels"].items())))
        yield {**saved, "split_name": row["split"] or "unspecified", "rows_written": row["rows"], "label_counts": counts}
    yield {**saved, "split_name": "all", "rows_written": counted.get["rows"]}


def ingest(
    spark: SparkSession, space: Workspace, sources: Sequence[tuple[SourceSpec, Mapping[str, DataFrame]]],
    batch_id: str, order: Sequence[str] = (), seed: int | None = 42, fail_if_any_source_fails: bool = False,
    fail_if_no_sources: bool = True,
) -> str:
    """Every source into the canonical folder. A broken source becomes a manifest row, not a broken run."""
    manifest, failed, done = [], [], []
    for spec, splits in sources:
        facts = {"dataset_key": spec.key, "dataset_id": spec.dataset_id, "source_platform": spec.source_platform}
        if not spec.enabled:
            manifest.append({**facts, "status": "skipped", "split_name": "all", "error_message": "source disabled"})
            continue
        try:
            for row in ingest_source(spark, space, spec, splits, batch_id, order, seed):
                manifest.append({**facts, **row})
            done.append(manifest[-1])
        except Exception as error:  # any source may fail in its own way; the others go on
            failed.append(spec.key)
            manifest.append(
                {**facts, "status": "failed", "split_name": spec.default_split, "error_message": str(error)}
            )
    schema = CONTROL_TABLES["source_dataset_manifest"]
    names = [f.name for f in schema.fields if f.name != "event_ts"]
    rows = [tuple({**row, "download_batch_id": batch_id}.get(n) for n in names) for row in manifest]
    frame = spark.createDataFrame(rows, type(schema)([schema[n] for n in names]))
    W.write_manifest(
        frame.withColumn("event_ts", F.current_timestamp()), space.table("source_dataset_manifest"),
        f"{space.root}/manifest/{batch_id}",
    )
    total = sum(row["rows_written"] for row in done)
    status = "PARTIAL_SUCCESS" if failed else "SUCCESS"
    if not total and fail_if_no_sources:
        raise RuntimeError(f"no source could be loaded; failed: {failed}")
    if failed and fail_if_any_source_fails:
        raise RuntimeError(f"required sources failed: {failed}")
    _log(spark, space, batch_id, "ingest", status, f"sources ok={len(done)} failed={len(failed)}", total)
    return status


def combined_canonical(spark: SparkSession, space: Workspace) -> DataFrame:
    """All sources together, one row per record hash."""
    rows = S.scan_canonical(spark, space.canonical, CANONICAL_BATCH)
    return keep_first(rows, ["source_record_hash"], ["source_path"])


def load_bronze(
    spark: SparkSession, space: Workspace, batch_id: str, landing: str | None = None, demo_if_empty: bool = False
) -> int:
    """New canonical or landing rows into bronze; a repeated run adds nothing."""
    with scratch_scope(spark):
        return _load_bronze(spark, space, batch_id, landing, demo_if_empty)


def _load_bronze(spark, space, batch_id, landing, demo_if_empty) -> int:
    if landing is not None:
        root, raw = landing, S.scan_landing_csv(spark, landing)
    else:
        root = space.canonical
        if demo_if_empty and not _has_files(spark, root):
            S.demo_rows(spark).write.mode("overwrite").parquet(f"{root}/demo")
        raw = S.scan_canonical(spark, root, CANONICAL_BATCH)
    rows = M.dedup_by_hash(M.bronze_filter(M.bronze_stage(raw, landing=landing is not None)))
    # Random ids are drawn once: the staged rows are what is appended, counted and audited.
    fresh = W.append_new_rows(M.technical_columns(rows, batch_id), space.table("bronze"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(
        "path", "length", "modificationTime"
    )
    audit = K.file_load_audit(fresh, batch_id, files)
    W.evolve_and_append(audit, space.table("ingestion_file_audit"))
    written = fresh.count()
    message = f"{written} new rows" if written else "no new rows"
    _log(spark, space, batch_id, "bronze", "SUCCESS", message, written)
    return written


def _has_files(spark: SparkSession, root: str) -> bool:
    """Whether the folder is there with a table file in it; an error while listing is an error."""
    return path_exists(spark, root) and bool(S.list_files(spark, root, [".parquet"]))


def _store_checks(spark, space, checks: DataFrame, run_id: str) -> list:
    """Checks are a handful of rows: stored first, enforced after, so a failed run leaves its evidence."""
    stamped = checks.withColumns({"run_id": F.lit(run_id), "event_ts": F.current_timestamp()})
    with scratch_scope(spark):
        kept = stage(stamped, "checks")
        W.evolve_and_append(kept, space.table("data_quality_results"))
        return K.enforce(kept)


def build_silver(spark: SparkSession, space: Workspace, run_id: str) -> int:
    """Silver and quarantine; the checks use what the two writes counted, without another pass."""
    counts, refused = Observation(), Observation()
    seen = [F.max((F.col("label_normalized") == name).cast("int")).alias(name) for name in LABELS]
    with scratch_scope(spark):
        # Cleaned once: both tables read the part of the staged rows that is theirs.
        path = scratch_path(spark, "silver_base")
        base = M.silver_flag(M.silver_base(spark.table(space.table("bronze"))))
        base.write.partitionBy("is_valid").parquet(path)
        base = spark.read.schema(base.schema).parquet(path)
        valid = M.silver_valid(base.where("is_valid"))
        rejected = M.silver_quarantine(base.where("NOT is_valid").drop("is_valid"))
        W.overwrite_table(valid.observe(counts, F.count(F.lit(1)).alias("rows"), *seen), space.table("silver"))
        W.overwrite_table(rejected.observe(refused, F.count(F.lit(1)).alias("rows")), space.table("silver_quarantine"))
    good, bad = counts.get["rows"], refused.get["rows"]
    classes = sum(counts.get[name] or 0 for name in LABELS)
    measured = spark.createDataFrame(
        [(good + bad, good, classes, bad)],
        "bronze_has_rows bigint, silver_has_rows bigint, valid_label_count bigint, quarantine_rows bigint",
    )
    _store_checks(spark, space, K.silver_checks(measured), run_id)
    _log(spark, space, run_id, "silver", "SUCCESS", f"{good} valid rows, {bad} in quarantine", good)
    return good


def build_gold(spark: SparkSession, space: Workspace, run_id: str, leak_free: bool = True) -> int:
    """Gold and the inference input; checks read the gold table just written."""
    rows = W.overwrite_table(M.gold(spark.table(space.table("silver")), leak_free), space.table("gold"))
    gold = spark.table(space.table("gold"))
    W.overwrite_table(M.inference_input(gold), space.table("inference_input"))
    _store_checks(spark, space, K.dq_gold(gold), run_id)
    _log(spark, space, run_id, "gold", "SUCCESS", f"{rows} rows", rows)
    return rows

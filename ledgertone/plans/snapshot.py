"""Dated feature snapshot with its reports."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgertone.operators import medallion as M
from ledgertone.operators import reports as R
from ledgertone.operators import splits as P
from ledgertone.session import scratch_scope
from ledgertone.sinks import tables as W
from ledgertone.sources import readers as S


def curate(spark: SparkSession, raw_root: str) -> DataFrame:
    return M.curated_select(S.scan_glob(spark, raw_root))


def write_snapshot(
    spark: SparkSession, curated: DataFrame, base: str, snapshot_date: str, key: Sequence[str] = ()
) -> dict[str, str]:
    """Replace one date's features and reports. The reports read the features as written.

    ``key`` names a unique row order; without one, rows are numbered as they lie, in a staged copy that is removed
    again, so that of identical rows exactly one is the first.
    """
    with scratch_scope(spark):
        order = list(key)
        if not order:
            curated, order = P.with_tie(curated), [P.TIE]
        features = R.model_features(curated, order, snapshot_date).drop(*order)
        W.overwrite_snapshot_partition(features, f"{base}/model_features")
    stored = S.scan_snapshot(spark, f"{base}/model_features", snapshot_date)
    reports = {
        "dataset_summary": R.dataset_summary(stored),
        "label_distribution": R.label_distribution(stored),
        "split_distribution": R.split_distribution(stored),
        "word_count_by_label": R.word_count_by_label(stored),
    }
    return W.write_reports_csv(reports, base, snapshot_date)

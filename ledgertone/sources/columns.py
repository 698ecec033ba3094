"""Plan-time column resolution; nothing here runs a job."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_column(columns: Sequence[str], candidates: Sequence[str], ignore_case: bool = False) -> str | None:
    """First candidate that exists; exact matches win over case-insensitive ones."""
    exact = next((c for c in candidates if c in columns), None)
    if exact is not None or not ignore_case:
        return exact
    by_lower = {c.lower(): c for c in reversed(columns)}
    return next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def resolve_column(
    df: DataFrame, candidates: Sequence[str], default: str | None = None, ignore_case: bool = False,
    required: bool = False,
) -> Column:
    found = find_column(df.columns, candidates, ignore_case)
    if found is not None:
        return _quoted(found).cast("string")
    if required:
        raise ValueError(f"none of {list(candidates)} found; available columns: {df.columns}")
    return F.lit(default).cast("string")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; available columns: {df.columns}")
    return df


def safe_column_names(names: Sequence[str]) -> list[str]:
    """Lower-case names of letters, digits and underscores; later copies get _2, _3, ..."""
    safe: list[str] = []
    for position, name in enumerate(names):
        base = re.sub(r"[^a-zA-Z0-9_]+", "_", name).strip("_").lower() or f"column_{position}"
        chosen, copy = base, 1
        while chosen in safe:
            copy += 1
            chosen = f"{base}_{copy}"
        safe.append(chosen)
    return safe


def with_safe_names(df: DataFrame, stringify: bool = False) -> DataFrame:
    renamed = df.toDF(*safe_column_names(df.columns))
    return renamed.select(*[F.col(c).cast("string") for c in renamed.columns]) if stringify else renamed


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no sources to combine")
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined

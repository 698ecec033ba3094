"""Every operator as a named query over the driver tables."""

from ledgertone.plans.catalog import (  # noqa: F401
    evaluation, features, medallion, quality, reports, scalars, sinks, sources, splits, streaming,
)
from ledgertone.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

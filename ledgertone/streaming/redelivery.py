"""Requests that arrive again: state per request, bounded by time, beside the result store.

The store already lets the newest result of a request win, so a re-delivery is never wrong, but it is scored and stored
once more. ``drop_redelivered`` remembers a digest of what was last passed on for each (date, request) and lets through
only what differs from it. A digest is forgotten by the first micro-batch, after ``remember``, that does not hold its
request. Nothing is lost:
no record counts as too late, one that comes after its digest was forgotten passes and replaces its result in the store,
and one with other content passes at once. State is the number of requests that arrived within that time.

Requests are kept in ``buckets``, whose number a checkpoint is bound to: a micro-batch calls Python once for each bucket,
not for each request. A bucket's state is 32 bytes for a request. Two requests of one 64-bit key displace each other's
digest, which costs time only, since the digest covers date and request.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgertone.streaming.requests import LOG_COLUMNS, result_date, utc_text

BUCKETS = 512
_PLACE = ["_arrived", "_partition", "_offset"]
_REDUCE_ROWS = 20_000


def _newest(pieces) -> pd.DataFrame | None:
    """The last row of each (date, request); no more than twice as many rows, or pieces of some rows, are held."""
    held, rows, most = [], 0, _REDUCE_ROWS

    def reduced():
        ordered = pd.concat(held).sort_values(_PLACE, kind="stable")
        return ordered.drop_duplicates(["_date", "request_id"], keep="last")

    for piece in pieces:
        held.append(piece)
        rows += len(piece)
        if rows > most:
            held = [reduced()]
            rows, most = len(held[0]), max(2 * len(held[0]), _REDUCE_ROWS)
    return reduced() if rows else None


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("bigint")


def drop_redelivered(
    validated: DataFrame, remember: pd.Timedelta | str = "1 hour", buckets: int = BUCKETS
) -> DataFrame:
    """Of a stream of validated requests, the last of each micro-batch per (date, request), unless nothing but its place
    in the log differs from what was passed on before.

    A record without submission time counts under the date of its arrival, or under none if the source does not tell.
    Records of one request are read in pieces, so that one that arrives very often stays within memory.
    """
    log = [c for c in LOG_COLUMNS if c in validated.columns]
    arrived = F.col("arrived_at") if "arrived_at" in log else F.lit(None).cast("timestamp")
    partition = F.col("log_partition") if "log_partition" in log else F.lit(0)
    offset = F.col("log_offset") if "log_offset" in log else F.col("position").cast("string").try_cast("bigint")
    rows = validated.select(*log, "request_id", "text", "submitted_at", "error_message")
    passed = rows.schema
    date = F.coalesce(result_date(F.col("submitted_at"), utc_text(arrived)), F.lit(""))
    rows = rows.withColumns({
        "_date": date, "_arrived": F.coalesce(F.unix_micros(arrived), F.lit(-1)),
        "_partition": F.coalesce(partition, F.lit(-1)), "_offset": F.coalesce(offset, F.lit(-1)),
    })
    content = F.to_json(F.struct("_date", "request_id", "text", "submitted_at", "error_message"))
    rows = rows.withColumns({"_digest": F.sha2(content, 256), "_key": F.xxhash64("_date", "request_id")})
    rows = rows.withColumns({"_first": _half(F.col("_digest"), 1), "_second": _half(F.col("_digest"), 17)})
    # Numbers travel as text: pandas would turn a column with nulls into doubles.
    numbers = {f.name: f.dataType for f in passed if isinstance(f.dataType, T.IntegralType)}
    rows = rows.withColumns({c: F.col(c).cast("string") for c in numbers}).drop("_digest")
    shipped = T.StructType([rows.schema[f.name] for f in passed])
    rows = rows.withColumn("_bucket", F.pmod("_key", F.lit(buckets)).cast("int"))
    names = passed.names
    lasts = int(pd.Timedelta(remember) / pd.Timedelta(milliseconds=1))

    def changed(key, pieces, state: GroupState):
        """The state's rows are (key, two halves of the digest, when it was last met), in the order of the keys."""
        now = state.getCurrentProcessingTimeMs()
        known = np.frombuffer(state.get[0], np.int64).reshape(-1, 4) if state.exists else np.empty((0, 4), np.int64)
        last = None if state.hasTimedOut else _newest(pieces)
        held = known[:, 3] + lasts >= now
        fresh = np.empty((0, 4), np.int64)
        if last is not None:
            told = last[["_key", "_first", "_second"]].to_numpy(np.int64)
            fresh = np.column_stack([told, np.full(len(told), now)])
            held &= ~np.isin(known[:, 0], told[:, 0])
            if len(known):
                at = np.minimum(np.searchsorted(known[:, 0], told[:, 0]), len(known) - 1)
                last = last[(known[at, :3] != told).any(axis=1)]
        kept = np.concatenate([known[held], fresh])
        kept = kept[np.unique(kept[:, 0], return_index=True)[1]]
        if len(kept):
            state.update((kept.tobytes(),))
            state.setTimeoutDuration(max(int(kept[:, 3].min()) + lasts - now, 1))
        elif state.exists:
            state.remove()
        if last is not None and len(last):
            yield last[names]

    found = rows.groupBy("_bucket").applyInPandasWithState(
        changed, shipped, "known binary", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return found.select(*[F.col(c).cast(numbers[c]).alias(c) if c in numbers else F.col(c) for c in names])

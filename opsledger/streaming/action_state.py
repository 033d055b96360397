"""Streaming transition audit of the action log with keyed state (E02/E03 incremental).

``applyInPandasWithState`` keeps one small state row per action (current
status, last event time, event and violation counts), so state does not grow
with the event volume.  Within a micro-batch an action's new events are sorted
by (time, id) and checked against the previous status carried in state, in
vectorised pandas.  Events older than the action's last seen event are counted
as out of order (a stream cannot re-sequence history that already left).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.actions import REOPENABLE, STATUSES, TERMINAL, TRANSITIONS

OUTPUT_SCHEMA = (
    "action_id long, events long, violations long, out_of_order long, current_status string, "
    "last_event_at timestamp"
)
STATE_SCHEMA = "status string, last_at timestamp, last_id long, events long, violations long, out_of_order long"
ALLOWED = {
    (s, n) for s, nexts in TRANSITIONS.items() for n in list(nexts) + (["proposed"] if s in REOPENABLE else [])
}


def _violations(prev: pd.Series, nxt: pd.Series) -> pd.Series:
    known = nxt.isin(STATUSES)
    first = prev.isna()
    pair_ok = pd.Series([(p, n) in ALLOWED for p, n in zip(prev, nxt)], index=nxt.index, dtype=bool)
    ok = known & ((first & (nxt == "proposed")) | (~first & ~prev.isin(TERMINAL) & pair_ok))
    return ~ok


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (action_id,) = key
    new = pd.concat(list(batches), ignore_index=True).sort_values(["created_at", "event_id"], kind="stable")
    if state.exists:
        status, last_at, last_id, events, violations, late = state.get
    else:
        status, last_at, last_id, events, violations, late = None, None, None, 0, 0, 0
    if last_at is not None:
        ts = pd.Timestamp(last_at)
        stale = (new.created_at < ts) | ((new.created_at == ts) & (new.event_id <= last_id))
        late += int(stale.sum())
        new = new[~stale]
    if len(new):
        prev = new.status.shift(1)
        prev.iloc[0] = status
        violations += int(_violations(prev, new.status).sum())
        events += len(new)
        status = new.status.iloc[-1]
        last_at = new.created_at.iloc[-1].to_pydatetime()
        last_id = int(new.event_id.iloc[-1])
    state.update((status, last_at, last_id, events, violations, late))
    yield pd.DataFrame(
        [{"action_id": action_id, "events": events, "violations": violations, "out_of_order": late,
          "current_status": status, "last_event_at": last_at}]
    )


def action_audit_stream(status_events: DataFrame) -> DataFrame:
    """Per-action running audit over a streaming (or batch) frame of
    (action_id, event_id, created_at, status)."""
    return status_events.select("action_id", "event_id", "created_at", "status").groupBy("action_id").applyInPandasWithState(
        _update, OUTPUT_SCHEMA, STATE_SCHEMA, "Update", GroupStateTimeout.NoTimeout
    )


def start_audit(spark, source_folder: str, query_name: str, checkpoint: str | None = None,
                file_name_glob: str = "events*.parquet", available_now: bool = True):
    """Stream event files -> per-action audit rows into an in-memory table named
    ``query_name`` (update mode).  The checkpoint (offsets and state store) lives
    under the cluster's ``spark.checkpoint.dir`` unless given."""
    from pyspark.sql import functions as F

    from ..session import checkpoint_dir
    from ..sources.adapters import Source
    from .status_stream import EVENT_SCHEMA

    raw = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", file_name_glob)
        .option("maxFilesPerTrigger", 1)
        .parquet(source_folder)
    )
    status = F.element_at(F.create_map(*[F.lit(x) for kv in Source.ACTION_STATUS.items() for x in kv]), F.col("event_type"))
    ev = raw.select(F.col("user_id").alias("action_id"), "event_id", F.col("ts").alias("created_at"), status.alias("status"))
    ckpt = checkpoint or checkpoint_dir(spark).rstrip("/") + f"/opsledger-streams/{query_name}"
    w = (
        action_audit_stream(ev).writeStream.outputMode("update").format("memory").queryName(query_name)
        .option("checkpointLocation", ckpt)
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()

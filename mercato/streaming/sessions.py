"""Sessions cut from an event stream (the streaming form of G1).

``session_window`` gives the same sessions as the batch cut: an event
extends a session when it arrives less than ``gap`` after the previous one
(window ends are exclusive, so a gap of exactly ``gap`` opens a new
session).  The watermark bounds the state: a session is emitted once the
watermark passes its end (last event + gap), and events later than the
watermark are not merged into already-emitted sessions.  State is kept per
(user, session) by Spark's state store and checkpointed with the query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_sessions(events: DataFrame, user: str = "user_id", ts: str = "ts",
                    tiebreak: str = "event_id", event_type: str = "event_type",
                    gap: str = "12 hours", watermark: str = "1 hour",
                    convert_types: Sequence[str] = ("purchase",),
                    cart_types: Sequence[str] = ("click",),
                    first_of: Sequence[str] = ()) -> DataFrame:
    """Streaming DataFrame of finished sessions (append mode).

    Columns: user, session_id (``"<user>@<start>"``: a stream cannot number
    sessions from the start of time), start_time, end_time, duration_seconds,
    n_events, conversion_status and ``first_<c>`` for ``first_of``.
    """
    t = F.col(ts).cast("timestamp")
    e = events.withColumn("_t", t).withWatermark("_t", watermark)
    order = F.struct(F.col("_t"), F.col(tiebreak))
    et = F.col(event_type)
    aggs = [F.min("_t").alias("start_time"), F.max("_t").alias("end_time"),
            F.count(F.lit(1)).alias("n_events"),
            F.max(et.isin(*convert_types)).alias("_conv"),
            F.max(et.isin(*cart_types)).alias("_cart")]
    aggs += [F.min_by(F.col(c), order).alias(f"first_{c}") for c in first_of]
    g = e.groupBy(F.col(user), F.session_window("_t", gap).alias("_w")).agg(*aggs)
    status = (F.when(F.col("_conv"), "converted")
               .when(F.col("_cart"), "abandoned").otherwise("browsed"))
    return g.select(
        user,
        F.concat_ws("@", F.col(user).cast("string"),
                    F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("session_id"),
        "start_time", "end_time",
        ((F.unix_micros("end_time") - F.unix_micros("start_time")) / F.lit(1_000_000))
        .cast("long").alias("duration_seconds"),
        "n_events", status.alias("conversion_status"),
        *[f"first_{c}" for c in first_of])


def start_session_sink(sessions: DataFrame, path: str, checkpoint: str,
                       available_now: bool = False) -> StreamingQuery:
    """Append finished sessions to a Parquet table; ``checkpoint`` must be a
    folder on shared storage (offsets and state live there, so the query
    resumes after a restart or lost executors)."""
    w = (sessions.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()

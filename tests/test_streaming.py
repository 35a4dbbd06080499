import os
import tempfile

from pyspark.sql import functions as F

from mercato.operators.sessions import build_sessions, sessionize
from mercato.streaming.sessions import start_session_sink, stream_sessions
from tests.conftest import SF_SMALL, rows


def test_stream_sessions_equal_batch_sessions(spark):
    events = (spark.read.parquet(f"{SF_SMALL}/events.parquet")
              .select("event_id", "ts", "user_id", "event_type",
                      F.get_json_object("props", "$.k").cast("int").alias("k")))
    src = tempfile.mkdtemp(prefix="mercato-ev-")
    events.write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = spark.readStream.schema(events.schema).parquet(os.path.join(src, "in"))
    q = start_session_sink(stream_sessions(stream, watermark="0 seconds", first_of=["k"]),
                           os.path.join(src, "out"), os.path.join(src, "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(src, "out"))
    batch = build_sessions(sessionize(events), first_of=["k"])
    cols = ["user_id", "start_time", "end_time", "duration_seconds", "n_events",
            "conversion_status", "first_k"]
    b = sorted(rows(batch.select("user_id", F.col("start_time").cast("timestamp"),
                                 F.col("end_time").cast("timestamp"), *cols[3:])))
    s = sorted(rows(got, *cols))
    # a session is emitted once the watermark (here: the latest event time)
    # reaches its end + gap; the still-open sessions stay in the state store
    import datetime as dt
    wm = rows(events.agg(F.max("ts")))[0][0]
    closed = [r for r in b if r[2] + dt.timedelta(hours=12) <= wm]
    assert len(closed) > 0 and s == closed

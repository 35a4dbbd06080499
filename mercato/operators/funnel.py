"""Ordered funnels: how far a session gets through steps taken in order.

``ordered_steps`` runs a step automaton over each session: from state s an
event of step s + 1 leads to s + 1, every other event changes nothing.  A
session may be as long as a user's whole history (a bot), so it is not scanned
in one piece: each (session, bucket) piece becomes a transition function, the
list of the states in which it ends for every state it may start in, and the
functions of a session's pieces are composed in order.  Composition is
associative, so the result is that of one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.exprs import half_up, ratio

#: Steps of a purchase and the event types that take them.
PURCHASE_STEPS = (("view", ("view",)), ("cart", ("click",)), ("checkout", ("purchase",)))
Steps = Sequence[tuple[str, Sequence[str]]]


def transition_functions(pieces: DataFrame, steps: Steps, user: str = "user_id", tiebreak: str = "event_id",
                         event_type: str = "event_type") -> DataFrame:
    """One row per (session, bucket) of ``sessionize(..., keep_bucket=True)``:
    ``fn``, whose element s is the state after the piece if it starts in s,
    and ``n_events``.

    From state s, the piece takes step s + 1 at its first event of that step,
    step s + 2 at the first later event of that one, and so on: a chain of
    minima of positions over the piece, all on one partitioning."""
    piece = Window.partitionBy(user, "session_seq", "_b")
    d = pieces.withColumn("_pos", F.row_number().over(piece.orderBy("_us", tiebreak)))
    ends = []
    for s in range(len(steps)):
        at, end = F.lit(0), F.lit(s)
        for j in range(s, len(steps)):
            name = f"_m{s}_{j}"
            takes = F.col(event_type).isin(*steps[j][1]) & (F.col("_pos") > at)
            d = d.withColumn(name, F.min(F.when(takes, F.col("_pos"))).over(piece))
            at = F.col(name)
            end = end + F.when(at.isNotNull(), 1).otherwise(0)
        d = d.withColumn(f"_e{s}", end)
        ends.append(f"_e{s}")
    fn = F.array(*[F.max(e) for e in ends], F.lit(len(steps)))
    return d.groupBy(user, "session_seq", "_b").agg(fn.alias("fn"), F.count(F.lit(1)).alias("n_events"))


def ordered_steps(pieces: DataFrame, steps: Steps = PURCHASE_STEPS, user: str = "user_id", tiebreak: str = "event_id",
                  event_type: str = "event_type") -> DataFrame:
    """One row per session: ``steps_taken`` (how many steps it takes in order,
    other events between them allowed) and ``furthest_step`` (NULL if it does
    not take the first).  ``pieces`` are events from
    ``sessionize(..., keep_bucket=True)``; events of a step that comes too
    early do not count.  A session's row gathers one small list per non-empty
    bucket, not its events."""
    fns = transition_functions(pieces, steps, user, tiebreak, event_type)
    parts = F.sort_array(F.collect_list(F.struct("_b", "fn")))
    s = fns.groupBy(user, "session_seq").agg(parts.alias("_parts"), F.sum("n_events").alias("n_events"))
    state = F.aggregate("_parts", F.lit(0), lambda at, part: F.get(part["fn"], at))
    names = F.array(*[F.lit(n) for n, _ in steps])
    return (s.withColumn("steps_taken", state)
             .select(F.concat_ws("-", F.col(user).cast("string"), F.col("session_seq").cast("string")).alias("session_id"),
                     user, "n_events", "steps_taken",
                     F.when(F.col("steps_taken") > 0, F.get(names, F.col("steps_taken") - 1)).alias("furthest_step")))


def funnel_steps(sessions: DataFrame, steps: Steps = PURCHASE_STEPS) -> DataFrame:
    """One row per step of ``ordered_steps``: sessions that take it, their
    share of all sessions and of those that take the step before (in %, 2
    places; NULL when there are none)."""
    n = len(steps)
    counts = sessions.agg(F.count(F.lit(1)).alias("all"), *[
        F.count(F.when(F.col("steps_taken") >= i, 1)).alias(f"s{i}") for i in range(1, n + 1)])
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(steps[i - 1][0]).alias("step_name"),
                              F.col(f"s{i}").alias("sessions"), F.col("all").alias("_all"),
                              F.col(f"s{i - 1}" if i > 1 else "all").alias("_prior")) for i in range(1, n + 1)])
    pct = lambda of: half_up(ratio(F.col("sessions") * 100, F.col(of)), 2)
    return (counts.select(F.explode(rows).alias("r")).select("r.*")
            .select("step", "step_name", "sessions", pct("_all").alias("pct_of_sessions"), pct("_prior").alias("pct_of_previous"))
            .orderBy("step"))

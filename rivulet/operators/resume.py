"""Where to resume, and how bad a streak of early stops is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEALTHY_S, ERROR_STREAK = 60, 5


def resume_decisions(cases: DataFrame, max_catch_up: float, from_end_on_failure: bool = False) -> DataFrame:
    """cases (stored_t, store_failed, end_t, as_of_t) with start_t and decision.

    resume: a stored position younger than the catch-up limit (strictly).  end: too old or missing, or
    a failed store with from_end_on_failure.  now: the end of the log is not known either.  fail: else.
    """
    young = F.col("stored_t") > F.col("as_of_t") - F.lit(max_catch_up)
    d = F.when(F.col("store_failed"), "end" if from_end_on_failure else "fail").when(young, "resume").otherwise("end")
    d = F.when((d == "end") & F.col("end_t").isNull(), "now").otherwise(d)
    start = F.when(d == "resume", F.col("stored_t")).when(d == "end", F.col("end_t")).when(d == "now", F.col("as_of_t"))
    return cases.withColumns({"start_t": start, "decision": d})


def start_position(
    read: Callable[[], tuple[int, int] | None],
    end_of_log: Callable[[], tuple[int, int]],
    now_t: float,
    max_catch_up: float = 120.0,
    retries: int = 5,
    delay: float = 0.5,
    from_end_on_failure: bool = False,
    sleep: Callable[[float], None] | None = None,
    observe: Callable[[str, float], None] = lambda status, gap_s: None,
) -> tuple[tuple[int, int], Exception | None]:
    """(position, error) for a runner: the same policy with a store that may fail.

    read returns the stored position or None.  Try k (from 0) is followed by a pause of k * delay.
    observe hears of the gap in whole seconds: success for one that is caught up, failed for one that
    is too old, and failed with 0 if no position could be read.  An error beside the position says that
    the end of the log is not known.
    """
    import time

    stored, error = None, None
    for k in range(max(1, retries)):
        try:
            stored, error = read(), None
            break
        except Exception as e:  # noqa: BLE001  any failure of the store counts
            error = e
            (sleep or time.sleep)(k * delay)
    if error is not None:
        observe("failed", 0)
        if not from_end_on_failure:
            raise error
    if stored is not None:
        young = stored[0] > now_t - max_catch_up
        observe("success" if young else "failed", int(now_t - stored[0]))
        if young:
            return stored, None
    try:
        return end_of_log(), None
    except Exception as e:  # noqa: BLE001
        return (int(now_t), 0), e


def gaps(decisions: DataFrame) -> DataFrame:
    """(status, gap_s) of resume_decisions: success and failed with the stored position's age in whole seconds, failed with 0 where it could not be read; a missing one is no gap."""
    age = F.floor(F.col("as_of_t") - F.col("stored_t")).cast("long")
    status = F.when(F.col("decision") == "resume", "success").otherwise("failed")
    return decisions.where("store_failed or stored_t is not null").select(status.alias("status"), F.when(F.col("store_failed"), F.lit(0).cast("long")).otherwise(age).alias("gap_s"))


def streaks(stops: DataFrame) -> DataFrame:
    """stops (run_id, started_t, stopped_t) with streak and level.

    A run of HEALTHY_S or more restarts the streak at 1; each earlier stop adds one; ERROR_STREAK in a
    row is an error.  Healthy runs are counted by day, so only a row for each day is in one task.
    """
    d = stops.withColumns({"_long": (F.col("stopped_t") - F.col("started_t") >= HEALTHY_S).cast("long"), "_day": F.floor(F.col("started_t") / 86_400)})
    days = d.groupBy("_day").agg(F.sum("_long").alias("_n")).selectExpr("_day", "sum(_n) over (order by _day) - _n as _before")
    d = d.join(days, "_day").selectExpr("*", "_before + sum(_long) over (partition by _day order by started_t, run_id) as _part")
    d = d.selectExpr("*", "row_number() over (partition by _part order by started_t, run_id) as streak")
    return d.withColumn("level", F.when(F.col("streak") >= ERROR_STREAK, "error").otherwise("warn")).select(*stops.columns, "streak", "level")


class Streak:
    """The same for a runner, one stop at a time."""

    def __init__(self):
        self.n = 0

    def stopped(self, ran_s: float) -> tuple[int, str]:
        self.n = 1 if ran_s >= HEALTHY_S else self.n + 1
        return self.n, "error" if self.n >= ERROR_STREAK else "warn"

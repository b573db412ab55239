"""Histories: quality-report trends (DQ17, WIN4, WIN5), pipeline-run health (AGG12) and
structured-log queries (AGG13).

Histories may be long: ordered passes run over ranges of time, and the newest lines of a
log are read from its newest days.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesforge.functions.ordered import in_order
from salesforge.functions.schema import LOG_SCHEMA
from salesforge.functions.semantics import round_half_even, ts_lit
from salesforge.scratch import Scratch, file_system


def summary_report(history: DataFrame) -> DataFrame:
    """DQ17: one row over a ``quality_history`` table (timestamp, total_records,
    overall_score, n_issues)."""
    return history.agg(F.count(F.lit(1)).alias("total_reports"),
                       F.min("timestamp").alias("start"), F.max("timestamp").alias("end"),
                       F.avg("overall_score").alias("avg_score"), F.min("overall_score").alias("min_score"),
                       F.max("overall_score").alias("max_score"),
                       F.sum("n_issues").alias("total_issues"), F.sum("total_records").alias("total_records"))


def score_trend(history: DataFrame) -> DataFrame:
    """WIN4: (last - first) / n per report, its direction, total change, population
    variance (all rounded to 2 places).  Fewer than two reports give a message row."""
    one = history.agg(F.count(F.lit(1)).alias("n"),
                      F.min_by("overall_score", "timestamp").alias("first"),
                      F.max_by("overall_score", "timestamp").alias("last"),
                      F.var_pop("overall_score").alias("var"))
    trend = (F.col("last") - F.col("first")) / F.col("n")
    enough = F.col("n") >= 2
    return one.select(
        F.when(enough, F.when(trend > 0, "improving").when(trend < 0, "declining").otherwise("stable"))
         .alias("direction"),
        F.when(enough, round_half_even(trend, 2)).alias("change_per_report"),
        F.when(enough, round_half_even(F.col("last") - F.col("first"), 2)).alias("total_change"),
        F.when(enough, round_half_even(F.col("var"), 2)).alias("score_variance"),
        F.when(~enough, F.lit("Insufficient data for trend analysis")).alias("message"))


def stable_periods(history: DataFrame, threshold: float = 5.0) -> DataFrame:
    """WIN5: maximal runs of >= 2 consecutive reports whose score moves by at most
    ``threshold`` per step (gaps and islands): start/end position (0-based, in time
    order), duration and mean score.

    A prefix scan over ranges of time: every range counts its own steps, one row per range
    (rows, first and last score, breaks) carries the last score and the numbers of rows and
    islands into the next, and a range's rows add what was carried to their own."""
    scratch = Scratch(history.sparkSession)
    held = in_order(history.select("timestamp", "overall_score"), [F.col("timestamp"), F.col("overall_score")], scratch, label="history")
    local = Window.partitionBy("range").orderBy("number")
    jump = lambda a, b: F.coalesce((F.abs(a - b) > F.lit(threshold)).cast("int"), F.lit(0))
    score = F.col("overall_score")
    steps = held.withColumn("brk", jump(score, F.lag(score).over(local)))  # the first of a range has no break yet
    ends = steps.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("brk").alias("breaks"),
                                      F.min_by(score, "number").alias("first"), F.max_by(score, "number").alias("last"))
    over = Window.orderBy("range")  # one row per range of the shuffle, whose number is a setting
    ends = ends.withColumn("edge", jump(F.col("first"), F.lag("last").over(over)))
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("range", "edge", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
                          (F.coalesce(F.sum(F.col("breaks") + F.col("edge")).over(before), F.lit(0)) + F.col("edge")).alias("islands_before"))
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (steps.withColumn("inner", F.sum("brk").over(upto)).join(F.broadcast(carried), "range")
         .select(score, (F.col("rows_before") + F.col("number")).alias("idx"), (F.col("islands_before") + F.col("inner")).alias("island")))
    return (s.groupBy("island")
            .agg(F.min("idx").alias("start_index"), F.max("idx").alias("end_index"),
                 F.count(F.lit(1)).alias("duration"), F.avg("overall_score").alias("avg_score"))
            .where(F.col("duration") > 1)
            .select(F.col("start_index").cast("bigint"), F.col("end_index").cast("bigint"),
                    "duration", "avg_score"))


def pipeline_health(runs: DataFrame, as_of: datetime, keep_last: int | None = None) -> DataFrame:
    """AGG12: last run, the counts of the day of ``as_of`` and the success rate over all
    runs, in one map-side combined aggregate.  ``keep_last`` restricts it to the latest
    runs, for histories that are kept as a bounded list."""
    kept = runs if keep_last is None else runs.orderBy(F.col("timestamp").desc()).limit(keep_last)
    today = F.to_date("timestamp") == F.to_date(ts_lit(as_of))
    return kept.agg(
        F.max("timestamp").alias("last_run_time"),
        F.max_by(F.when(F.col("success"), "success").otherwise("failed"), "timestamp").alias("last_run_status"),
        F.max_by("duration_seconds", "timestamp").alias("last_run_duration_seconds"),
        F.count_if(today).alias("total_runs_today"),
        F.count_if(today & F.col("success")).alias("successful_runs_today"),
        F.count_if(today & ~F.col("success")).alias("failed_runs_today"),
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if("success").alias("successful_runs"),
    ).withColumn("success_rate", F.coalesce(F.try_divide(F.col("successful_runs").cast("double"),
                                                         F.col("total_runs").cast("double")) * F.lit(100.0),
                                            F.lit(0.0)))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """AGG13 source: structured JSON log lines with the log schema (extra keys ignored)."""
    return spark.read.schema(LOG_SCHEMA).json(path)


def tail_logs(logs: DataFrame, limit: int = 100, level: str | None = None) -> DataFrame:
    """AGG13: newest ``limit`` log lines, optionally of one level (case-insensitive)."""
    if level:
        logs = logs.where(F.upper(F.col("level")) == level.upper())
    return logs.orderBy(F.col("timestamp").desc(), *[F.col(c).asc() for c in logs.columns if c != "timestamp"]) \
        .limit(limit)


def store_logs(logs: DataFrame, path: str, mode: str = "append") -> None:
    """AGG13 store: log lines by day, for ``tail_stored``.  ``timestamp`` may be text."""
    day = F.coalesce(F.date_format(F.to_date(F.col("timestamp").cast("timestamp_ntz")), "yyyy-MM-dd"), F.lit("none"))
    logs.withColumn("day", day).hint("rebalance", "day").write.mode(mode).partitionBy("day").parquet(path)


def tail_stored(spark: SparkSession, path: str, limit: int = 100, level: str | None = None) -> DataFrame:
    """``tail_logs`` of a ``store_logs`` folder that reads the newest days only: the
    newest day first, then twice as many days at a time, until ``limit`` lines of the level
    are found.  Lines without a time are the oldest.  The driver sees one name per day."""
    fs, where = file_system(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()]
    days = sorted((n.removeprefix("day=") for n in names if n.startswith("day=")), key=lambda d: (d != "none", d), reverse=True)
    if not days:
        return tail_logs(spark.createDataFrame([], LOG_SCHEMA), 0)
    stored = spark.read.option("basePath", path)
    stored, logs = stored.schema(stored.parquet(f"{path}/day={days[0]}").schema), None
    found, upto, step = 0, 0, 1
    while found < limit and upto < len(days):
        new = stored.parquet(*[f"{path}/day={d}" for d in days[upto:upto + step]])
        found += (new.where(F.upper(F.col("level")) == level.upper()) if level else new).limit(limit).count()
        logs = new if logs is None else logs.unionByName(new)
        upto, step = upto + step, 2 * step
    return tail_logs(logs.drop("day"), limit, level)

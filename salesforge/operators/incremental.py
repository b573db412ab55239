"""DQ12 / RUL0 / UDF1 by parts: quality states that add up, so that appended data is
checked alone.

A store holds, for every part (a day, a month, a load), three small tables instead of its
rows: ``counts`` (every count of the metric framework and of the rules), ``days`` (rows per
calendar day, and how many of them at midnight) and ``keys`` (how often each different row
occurs, by the digest of its content).  All of them merge by adding.  A report merges the
parts it covers: the counts by one sum per name, rows in the future or out of date from
the days, and duplicates, which may lie in different parts, from the keys.  So adding a
part reads that part only, and a report reads no data rows.

``add`` writes the states of all parts it is given in one go, each part as a partition of
its own, and ``counts`` last; a part that is added again replaces what it had, so an add
that was interrupted is simply repeated.  Parts are known by ``counts`` alone.

Rules may look at the clock (``as_of``) in their aggregates, so a store with rules has one
``as_of``; without rules a report can be made as of any midnight.
"""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.errors import PipelineError
from salesforge.operators.fingerprint import row_key
from salesforge.operators.quality import FRESHNESS_DAYS, QualityReport, report_of, stat_columns
from salesforge.operators.rules import DataQualityRules
from salesforge.scratch import Scratch


class QualityStore:
    """Quality states of the parts of one table, in the folder ``path``.  ``columns``:
    an empty frame with the table's columns and types."""

    def __init__(self, path: str, columns: DataFrame, rules: DataQualityRules | None = None, as_of: datetime | None = None):
        self.spark: SparkSession = columns.sparkSession
        self.path, self.columns, self.rules, self.as_of = path, columns.limit(0), rules, as_of
        if rules is not None and as_of is None:
            raise ValueError("rules are counted as of a point in time")

    def _rule_checks(self, df: DataFrame):
        rules = self.rules.get_enabled_rules()
        return rules, self.rules.checks(df, rules, self.as_of)

    def add(self, rows: DataFrame, part: Column) -> None:
        """Count ``rows``; ``part`` (a text over their columns) names the part of each."""
        if [(f.name, f.dataType) for f in rows.schema.fields] != [(f.name, f.dataType) for f in self.columns.schema.fields]:
            raise PipelineError("The part has other columns than the store", "QUALITY_409", {"columns": rows.columns})
        scratch = Scratch(self.spark)
        staged = scratch.table(rows.withColumn("_part", F.coalesce(part.cast("string"), F.lit("none"))), "part")
        parsed, aggs = stat_columns(staged)
        if self.rules is not None:
            aggs += self.rules.columns(self._rule_checks(staged)[1])[0]
        counts = parsed.groupBy(F.col("_part").alias("part")).agg(*aggs).drop("nn__part")
        names = counts.columns[1:]
        each = F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(n).cast("bigint") for n in names])))
        if "date" in self.columns.columns:
            day = F.to_date("__date")
            days = parsed.where(F.col("__date").isNotNull()).groupBy(F.col("_part").alias("part"), day.alias("day")).agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("__date") == day.cast("timestamp_ntz")).alias("midnight"))
            self._replace(days, "days")
        keys = staged.groupBy(F.col("_part").alias("part"), F.unhex(row_key(self.columns)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        self._replace(keys, "keys")
        self._replace(counts.select("part", each.alias("name", "n")), "counts")
        scratch.release()

    def _replace(self, df: DataFrame, what: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/{what}")

    def _read(self, what: str, parts: list[str] | None) -> DataFrame | None:
        try:
            held = self.spark.read.option("inferPartitionColumnTypes", False).parquet(f"{self.path}/{what}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        held = held.withColumn("part", F.col("part").cast("string"))
        return held if parts is None else held.where(F.col("part").isin(parts))

    def merged(self, as_of: datetime, parts: list[str] | None = None) -> dict:
        """The counts of all parts, or of ``parts``, as ``quality.collect_stats`` gives them."""
        if as_of.time() != time(0):
            raise ValueError("days tell what lies before a midnight only")
        counts = self._read("counts", parts)
        s = {} if counts is None else {r["name"]: r["n"] for r in counts.groupBy("name").agg(F.sum("n").alias("n")).collect()}
        if not s:  # no part: the counts of an empty table
            parsed, aggs = stat_columns(self.columns)
            s = parsed.agg(*aggs).first().asDict()
        known = None if counts is None else counts.select("part").distinct()
        s["duplicates"] = 0
        keys = self._read("keys", parts)
        if keys is not None:
            each = keys.join(known, "part", "left_semi").groupBy("key").agg(F.sum("n").alias("n"))
            s["duplicates"] = each.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
        if "date" in self.columns.columns:
            s["future"] = s["old"] = 0
            days = self._read("days", parts)
            if days is not None:
                now, fresh = F.lit(as_of.date()), F.lit((as_of - timedelta(days=FRESHNESS_DAYS)).date())
                future = F.when(F.col("day") > now, F.col("n")).when(F.col("day") == now, F.col("n") - F.col("midnight"))
                old = F.when(F.col("day") < fresh, F.col("n"))
                zero = F.lit(0)
                found = days.join(known, "part", "left_semi").agg(F.coalesce(F.sum(future), zero), F.coalesce(F.sum(old), zero)).first()
                s["future"], s["old"] = found
        return s

    def report(self, as_of: datetime | None = None, parts: list[str] | None = None, score_mode: str = "intended") -> QualityReport:
        """DQ12 over all parts, or over ``parts``."""
        as_of = as_of or self.as_of
        return report_of(self.spark, self.columns.columns, self.merged(as_of, parts), as_of, score_mode)

    def rule_results(self, parts: list[str] | None = None) -> DataFrame:
        """RUL0 over all parts, or over ``parts``; user rules (UDF1) too, whose aggregates
        must be counts or sums."""
        rules, checks = self._rule_checks(self.columns)
        row = dict.fromkeys(self.columns.agg(*self.rules.columns(checks)[0]).columns, 0) | self.merged(self.as_of, parts)
        return self.rules.result_df(self.spark, rules, self.rules.judged(rules, checks, row))

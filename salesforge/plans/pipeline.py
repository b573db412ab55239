"""Composition of the stages into one batch run.

ingest -> quality report (pre) -> warn-only gate -> [validate, transform] (order is a
parameter) -> quality report (post) -> load -> analytics.  The typed input and the
transformed output are each read by several jobs, so both are materialised once
(reliable checkpoint in the cluster's checkpoint folder when one is configured,
otherwise persisted).
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame

from salesforge.operators import analytics as A
from salesforge.operators import anomalies as O
from salesforge.operators import queries as Q
from salesforge.operators import quality as DQ
from salesforge.operators import transform as T
from salesforge.operators import validate as V
from salesforge.session import materialize

log = logging.getLogger(__name__)


@dataclass
class PipelineResult:
    pre_report: DQ.QualityReport
    post_report: DQ.QualityReport
    accepted: DataFrame
    rejected: DataFrame | None
    transformed: DataFrame
    insights: DataFrame
    product_performance: DataFrame
    load_metrics: DataFrame
    gate_passed: bool
    durations: dict[str, float] = field(default_factory=dict)
    settled: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Free what the run persisted, once its frames have been read.  Checkpointed
        stages go with their files when Spark's cleaner finds them unused."""
        for df in self.settled:
            df.unpersist()


def run(source: DataFrame, as_of: datetime, order: tuple[str, str] = ("validate", "transform"),
        min_score: float = 70.0, sink=None, materialize_stages: bool = True) -> PipelineResult:
    """Run the batch pipeline over ``source`` (typed sales rows).

    ``sink`` is an optional callable ``sink(transformed_df)`` (e.g. a partial of
    ``sinks.load_to_table``).  The gate only warns, as in the reference.
    """
    t0 = time.time()
    durations: dict[str, float] = {}

    def lap(name: str):
        nonlocal t0
        now = time.time()
        durations[name] = now - t0
        t0 = now

    df = materialize(source) if materialize_stages else source
    lap("ingest")
    pre = DQ.run_all_checks(df, as_of)
    gate_ok = pre.is_acceptable(min_score)
    if not gate_ok:
        log.warning("Input quality below threshold: score %.1f, %d critical issues",
                    pre.overall_score, len(pre.critical_issues()))
    lap("quality_pre")

    rejected = None
    cur = accepted = df
    for stage in order:
        if stage == "validate":
            res = V.validate_sales(cur, mode="quarantine")
            cur, accepted, rejected = res.accepted, res.accepted, res.rejected
        elif stage == "transform":
            cur = T.transform(cur, as_of, date_errors="coerce")
        else:
            raise ValueError(f"unknown stage {stage}")
    transformed = materialize(cur) if materialize_stages else cur
    lap("validate_transform")

    post = DQ.run_all_checks(transformed, as_of)
    lap("quality_post")
    if sink is not None:
        sink(transformed)
        lap("load")

    insights = A.insights(transformed, O.anomaly_count(A.prepare(transformed), "iqr"))
    perf = A.product_performance(transformed)
    load = A.load_metrics(transformed, Q.sales_by_date(transformed))
    lap("analytics_plan")
    return PipelineResult(pre, post, accepted, rejected, transformed, insights, perf, load, gate_ok, durations,
                          [df, transformed] if materialize_stages else [])

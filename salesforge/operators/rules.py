"""RUL0-RUL11 and UDF1: a registry of quality rules evaluated in one aggregate.

A rule contributes aggregate ``Column``s (evaluated together with every other enabled
rule in a single ``agg`` over the table) and a pure ``evaluate`` function that turns the
aggregated values into ``{passed, score, issues}`` on the driver.  User rules (UDF1) use
the same two hooks, so no Python runs per row and adding a rule adds no scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesforge.functions.schema import NUMERIC_SALES_COLUMNS, RULE_REQUIRED
from salesforge.functions.semantics import NUMERIC_TYPES, num, ts, ts_lit
from salesforge.operators.quality import duplicate_count

DUPLICATES = "__duplicates__"
RESULT_SCHEMA = ("rule_order bigint, rule_name string, severity string, threshold double, passed boolean, "
                 "score double, issues array<string>, error string")


@dataclass
class RuleCheck:
    """What a rule needs from the data (``aggs``; the special value ``DUPLICATES``
    requests the duplicate-row count) and how to judge it (``evaluate``)."""

    aggs: dict[str, Column | str] = field(default_factory=dict)
    evaluate: Callable[[dict], dict] = lambda v: {"passed": True, "score": 100.0, "issues": []}


@dataclass
class QualityRule:
    name: str
    description: str
    severity: str
    check: Callable[[DataFrame, dict], RuleCheck]
    threshold: float
    enabled: bool = True


def _rate(n: int, bad: int) -> float | None:
    return ((n - bad) / n) * 100 if n else None


def _scored(rule_threshold: float, n: int, bad: int, issues: list[str]) -> dict:
    score = _rate(n, bad)
    if score is None:
        return {"passed": False, "score": None, "issues": issues, "error": "division by zero"}
    return {"passed": score >= rule_threshold, "score": score, "issues": issues}


def _numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC_TYPES)


# ---------------------------------------------------------------------------------------
# Built-in rules (RUL1-RUL11).  Fixed values: their names, thresholds and messages.
# ---------------------------------------------------------------------------------------
def _required_fields(df: DataFrame, ctx: dict) -> RuleCheck:
    missing = [c for c in RULE_REQUIRED if c not in df.columns]
    if missing:
        return RuleCheck(evaluate=lambda v: {"passed": False, "score": 0.0,
                                             "issues": [f"Missing required fields: {missing}"]})
    return RuleCheck(evaluate=lambda v: {"passed": True, "score": 100.0, "issues": []})


def _critical_data(df: DataFrame, ctx: dict) -> RuleCheck:
    fields = ["date", "product_id"]
    present = [c for c in fields if c in df.columns]
    aggs = {"n": F.count(F.lit(1))}
    aggs.update({f"miss_{c}": F.count_if(F.col(c).isNull()) for c in present})

    def ev(v):
        n = v["n"]
        total = sum(v[f"miss_{c}"] for c in present)
        issues = [f"Field {c} has {v[f'miss_{c}']} missing values" for c in present if v[f"miss_{c}"] > 0]
        if not n:
            return {"passed": False, "score": None, "issues": issues, "error": "division by zero"}
        score = ((n * len(fields) - total) / (n * len(fields))) * 100
        return {"passed": score >= ctx["threshold"], "score": score, "issues": issues}
    return RuleCheck(aggs, ev)


def _date_format(df: DataFrame, ctx: dict) -> RuleCheck:
    if "date" not in df.columns:
        return RuleCheck(evaluate=lambda v: {"passed": False, "score": 0.0, "issues": ["Date column not found"]})
    aggs = {"n": F.count(F.lit(1)), "ok": F.count(ts(df, "date"))}

    def ev(v):
        bad = v["n"] - v["ok"]
        return _scored(ctx["threshold"], v["n"], bad, [f"Found {bad} invalid date values"] if bad > 0 else [])
    return RuleCheck(aggs, ev)


def _numeric_values(df: DataFrame, ctx: dict) -> RuleCheck:
    present = [c for c in NUMERIC_SALES_COLUMNS if c in df.columns]
    aggs = {"n": F.count(F.lit(1))}
    aggs.update({f"ok_{c}": F.count(num(df, c)) for c in present})

    def ev(v):
        n = v["n"]
        bad = {c: n - v[f"ok_{c}"] for c in present}
        issues = [f"Field {c} has {bad[c]} invalid numeric values" for c in present if bad[c] > 0]
        expected = n * len(present)
        score = ((expected - sum(bad.values())) / expected) * 100 if expected > 0 else 0
        return {"passed": score >= ctx["threshold"], "score": float(score), "issues": issues}
    return RuleCheck(aggs, ev)


def _calculations(df: DataFrame, ctx: dict) -> RuleCheck:
    if not all(c in df.columns for c in NUMERIC_SALES_COLUMNS):
        return RuleCheck(evaluate=lambda v: {"passed": False, "score": 0.0,
                                             "issues": ["Missing fields required for calculation check"]})
    q, p, d, t = (num(df, c) for c in NUMERIC_SALES_COLUMNS)
    aggs = {"n": F.count(F.lit(1)), "bad": F.count_if(F.abs(t - q * p * (F.lit(1) - d)) > 0.01)}

    def ev(v):
        bad = v["bad"]
        return _scored(ctx["threshold"], v["n"], bad,
                       [f"Found {bad} records with inconsistent calculations"] if bad > 0 else [])
    return RuleCheck(aggs, ev)


def _duplicates(df: DataFrame, ctx: dict) -> RuleCheck:
    aggs = {"n": F.count(F.lit(1)), "dup": DUPLICATES}

    def ev(v):
        dup = v["dup"]
        out = _scored(ctx["threshold"], v["n"], dup, [f"Found {dup} duplicate records"] if dup > 0 else [])
        if out.get("score") is not None:
            out["passed"] = dup == 0
        return out
    return RuleCheck(aggs, ev)


def _count_rule(column: str, missing_msg: str, bad_expr: Callable[[Column], Column], msg: str):
    def check(df: DataFrame, ctx: dict) -> RuleCheck:
        if column not in df.columns:
            return RuleCheck(evaluate=lambda v: {"passed": False, "score": 0.0, "issues": [missing_msg]})
        if not _numeric(df, column):
            return RuleCheck(evaluate=lambda v: {"passed": False, "score": None, "issues": [],
                                                 "error": f"column {column} is not numeric"})
        aggs = {"n": F.count(F.lit(1)), "bad": F.count_if(bad_expr(F.col(column)))}

        def ev(v):
            bad = v["bad"]
            out = _scored(ctx["threshold"], v["n"], bad, [msg.format(bad)] if bad > 0 else [])
            if out.get("score") is not None:
                out["passed"] = bad == 0
            return out
        return RuleCheck(aggs, ev)
    return check


def _future_dates(df: DataFrame, ctx: dict) -> RuleCheck:
    if "date" not in df.columns:
        return RuleCheck(evaluate=lambda v: {"passed": False, "score": 0.0, "issues": ["Date column not found"]})
    d = ts(df, "date")
    aggs = {"n": F.count(F.lit(1)), "bad": F.count_if(d > ts_lit(ctx["as_of"])),
            "unparseable": F.count_if(F.col("date").isNotNull() & d.isNull())}

    def ev(v):
        if v["unparseable"]:
            return {"passed": False, "score": 0.0,
                    "issues": [f"Error checking future dates: {v['unparseable']} unparseable date values"]}
        bad = v["bad"]
        out = _scored(ctx["threshold"], v["n"], bad, [f"Found {bad} records with future dates"] if bad > 0 else [])
        if out.get("score") is not None:
            out["passed"] = bad == 0
        return out
    return RuleCheck(aggs, ev)


def _recent_data(df: DataFrame, ctx: dict) -> RuleCheck:
    if "date" not in df.columns:
        return RuleCheck(evaluate=lambda v: {"passed": False, "score": 0.0, "issues": ["Date column not found"]})
    d = ts(df, "date")
    cutoff = ctx["as_of"] - timedelta(days=30)
    aggs = {"n": F.count(F.lit(1)), "old": F.count_if(d < ts_lit(cutoff)),
            "unparseable": F.count_if(F.col("date").isNotNull() & d.isNull())}

    def ev(v):
        if v["unparseable"]:
            return {"passed": False, "score": 0.0,
                    "issues": [f"Error checking data freshness: {v['unparseable']} unparseable date values"]}
        old = v["old"]
        return _scored(ctx["threshold"], v["n"], old, [f"Found {old} records older than 30 days"] if old > 0 else [])
    return RuleCheck(aggs, ev)


def default_rules() -> list[QualityRule]:
    # Rule names, descriptions, severities and thresholds.
    return [
        QualityRule("required_fields_present", "Check that all required fields are present", "error",
                    _required_fields, 100.0),
        QualityRule("no_missing_critical_data", "Check for missing critical data fields", "error",
                    _critical_data, 99.0),
        QualityRule("valid_date_format", "Check that dates are in valid format", "error", _date_format, 99.0),
        QualityRule("valid_numeric_values", "Check that numeric fields contain valid numbers", "error",
                    _numeric_values, 99.0),
        QualityRule("calculation_consistency", "Check that calculated fields are consistent", "error",
                    _calculations, 99.0),
        QualityRule("no_duplicates", "Check for duplicate records", "warning", _duplicates, 100.0),
        QualityRule("positive_quantities", "Check that quantities are positive", "error",
                    _count_rule("quantity", "Quantity column not found", lambda c: c <= 0,
                                "Found {} records with non-positive quantities"), 100.0),
        QualityRule("valid_prices", "Check that prices are non-negative", "error",
                    _count_rule("unit_price", "Unit price column not found", lambda c: c < 0,
                                "Found {} records with negative prices"), 100.0),
        QualityRule("valid_discounts", "Check that discounts are between 0 and 1", "error",
                    _count_rule("discount", "Discount column not found", lambda c: (c < 0) | (c > 1),
                                "Found {} records with invalid discounts"), 100.0),
        QualityRule("no_future_dates", "Check that no dates are in the future", "error", _future_dates, 100.0),
        QualityRule("recent_data", "Check that data is reasonably recent", "warning", _recent_data, 80.0),
    ]


class DataQualityRules:
    """RUL0: rule registry.  ``run_all`` evaluates every enabled rule in one aggregate."""

    def __init__(self, rules: list[QualityRule] | None = None):
        self.rules: dict[str, QualityRule] = {}
        for r in (default_rules() if rules is None else rules):
            self.add_rule(r)

    def add_rule(self, rule: QualityRule) -> None:
        self.rules[rule.name] = rule

    def remove_rule(self, name: str) -> None:
        self.rules.pop(name, None)

    def enable_rule(self, name: str) -> None:
        if name in self.rules:
            self.rules[name].enabled = True

    def disable_rule(self, name: str) -> None:
        if name in self.rules:
            self.rules[name].enabled = False

    def get_rule(self, name: str) -> QualityRule | None:
        return self.rules.get(name)

    def get_enabled_rules(self) -> list[QualityRule]:
        return [r for r in self.rules.values() if r.enabled]

    @staticmethod
    def checks(df: DataFrame, rules: list[QualityRule], as_of: datetime) -> list[RuleCheck | Exception]:
        found = []
        for r in rules:
            try:
                found.append(r.check(df, {"threshold": r.threshold, "as_of": as_of}))
            except Exception as e:  # noqa: BLE001 - a broken rule is a failed result
                found.append(e)
        return found

    @staticmethod
    def columns(checks: list[RuleCheck | Exception]) -> tuple[list[Column], bool]:
        """The aggregates of all checks, and whether one wants the duplicate count."""
        cols, need_dup = [], False
        for i, c in enumerate(checks):
            for k, v in ({} if isinstance(c, Exception) else c.aggs).items():
                if isinstance(v, str) and v == DUPLICATES:
                    need_dup = True
                else:
                    cols.append(v.alias(f"r{i}__{k}"))
        return cols, need_dup

    @staticmethod
    def judged(rules: list[QualityRule], checks: list[RuleCheck | Exception], row: dict) -> list[dict]:
        out = []
        for i, (r, c) in enumerate(zip(rules, checks)):
            if isinstance(c, Exception):
                out.append({"rule_name": r.name, "passed": False, "error": str(c)})
                continue
            vals = {k: (row["duplicates"] if isinstance(v, str) and v == DUPLICATES else row[f"r{i}__{k}"])
                    for k, v in c.aggs.items()}
            try:
                res = c.evaluate(vals)
            except Exception as e:  # noqa: BLE001
                out.append({"rule_name": r.name, "passed": False, "error": str(e)})
                continue
            out.append({"rule_name": r.name, "passed": bool(res["passed"]), "score": res.get("score"),
                        "issues": list(res.get("issues", [])), "threshold": r.threshold,
                        "error": res.get("error")})
        return out

    def _evaluate(self, df: DataFrame, rules: list[QualityRule], as_of: datetime) -> list[dict]:
        checks = self.checks(df, rules, as_of)
        cols, need_dup = self.columns(checks)
        row: dict = {}
        if cols or need_dup:
            row = df.agg(*cols).first().asDict() if cols else {}
            if need_dup:
                row.update(duplicate_count(df).first().asDict())
        return self.judged(rules, checks, row)

    def run_rule(self, name: str, df: DataFrame, as_of: datetime) -> dict:
        rule = self.get_rule(name)
        if not rule or not rule.enabled:
            return {"error": f"Rule {name} not found or disabled"}
        return self._evaluate(df, [rule], as_of)[0]

    def run_all(self, df: DataFrame, as_of: datetime) -> DataFrame:
        """Every enabled rule; one row per rule (report-sized)."""
        rules = self.get_enabled_rules()
        return self.result_df(df.sparkSession, rules, self._evaluate(df, rules, as_of))

    @staticmethod
    def result_df(spark: SparkSession, rules: list[QualityRule], res: list[dict]) -> DataFrame:
        rows = [(i + 1, r.name, r.severity, float(r.threshold), x["passed"],
                 float(x["score"]) if x.get("score") is not None else None,
                 x.get("issues", []), x.get("error")) for i, (r, x) in enumerate(zip(rules, res))]
        return spark.createDataFrame(rows, RESULT_SCHEMA)

"""Registrations for the quality framework (DQ), rule engine (RUL), legacy scorer (LEG)
and histories (DQ17, WIN4, WIN5, AGG12, AGG13)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from salesforge.functions.schema import SALES_COLUMNS
from salesforge.operators import history as H
from salesforge.operators import incremental as IN
from salesforge.operators import legacy as L
from salesforge.operators import quality as DQ
from salesforge.operators import rules as RU
from salesforge.plans.oracle import AS_OF_SQL, DATE, DIRTY_CTE, HISTORY_CTE, NUM, ROW_KEY, RUNS_CTE, TEXT_CTE, R, with_
from salesforge.plans.registry import register, stable
from salesforge.scratch import Scratch
from salesforge.sources import fixtures as FX

NUM4 = ["quantity", "unit_price", "discount", "total_sales"]


def _report(spark, sf_dir, view="dirty"):
    df = FX.sales_dirty(spark, sf_dir) if view == "dirty" else FX.sales_text(spark, sf_dir)
    return DQ.run_all_checks(df, FX.AS_OF, samples=False)


# ---------------------------------------------------------------------------------------
# SQL for the quality metric rows (generated from the same spec as the Python side)
# ---------------------------------------------------------------------------------------
def _stats_cte(src: str, typed: bool) -> str:
    d = "date" if typed else DATE("date")
    num = (lambda c: c) if typed else NUM
    parts = ["count(*) AS n"] + [f"count({c}) AS nn_{c}" for c in SALES_COLUMNS]
    parts += [f"count({d}) AS date_ok",
              f"count(*) FILTER (WHERE date IS NOT NULL AND {d} IS NULL) AS date_bad_text",
              f"count(*) FILTER (WHERE {d} > {AS_OF_SQL}) AS future",
              f"count(*) FILTER (WHERE {d} < {AS_OF_SQL} - INTERVAL 30 DAY) AS old"]
    parts += [f"count({num(c)}) AS num_ok_{c}" for c in NUM4]
    if typed:
        parts += ["count(*) FILTER (WHERE abs(total_sales - quantity * unit_price * (1 - discount)) > 0.01) "
                  "AS inconsistent",
                  "count(*) FILTER (WHERE quantity <= 0) AS bad_quantity",
                  "count(*) FILTER (WHERE unit_price < 0) AS bad_price",
                  "count(*) FILTER (WHERE discount < 0 OR discount > 1) AS bad_discount"]
    cols = ", ".join(SALES_COLUMNS)
    return (f"st AS (SELECT {', '.join(parts)} FROM {src}),\n"
            f"dup AS (SELECT coalesce(sum(cnt - 1), 0) AS duplicates FROM "
            f"(SELECT count(*) AS cnt FROM {src} GROUP BY ALL_COLS)),\n"
            f"s AS (SELECT * FROM st, dup)").replace("GROUP BY ALL_COLS", f"GROUP BY {cols}")


def _rate(bad: str) -> str:
    return f"((n - ({bad})) / n) * 100"


def _metric_rows(typed: bool) -> list[tuple]:
    """(order, name, value_sql, threshold, passed_sql, description, category,
        issue: None | (rule_name, severity_sql, message_sql, affected_sql, columns))."""
    rows = []
    cells = " + ".join(f"nn_{c}" for c in SALES_COLUMNS)
    v = f"(({cells}) / (n * {len(SALES_COLUMNS)})) * 100"
    rows.append(("overall_completeness", v, 95.0, f"{v} >= 95.0",
                 "Percentage of non-null values across all columns", "completeness", None))
    for c in SALES_COLUMNS:
        thr = 99.0 if c in DQ.CRITICAL_COLUMNS else 95.0
        v = _rate(f"n - nn_{c}")
        msg = (f"'Column {c} has ' || CAST(n - nn_{c} AS VARCHAR) || ' null values (' || printf('%.1f', {v}) "
               f"|| '% complete)'")
        rows.append((f"completeness_{c}", v, thr, f"{v} >= {thr}", f"Completeness percentage for column {c}",
                     "completeness",
                     (f"{v} < {thr}", "completeness", f"CASE WHEN {v} >= 90.0 THEN 'warning' ELSE 'error' END",
                      msg, f"n - nn_{c}", c)))
    v = _rate("n - date_ok")
    rows.append(("date_accuracy", v, 99.0, f"{v} >= 99.0", "Percentage of valid date values", "accuracy",
                 (f"{v} < 99.0", "date_accuracy", "'error'",
                  "'Found ' || CAST(n - date_ok AS VARCHAR) || ' invalid date values'", "n - date_ok", "date")))
    for c in NUM4:
        v = _rate(f"n - num_ok_{c}")
        rows.append((f"numeric_accuracy_{c}", v, 99.0, f"{v} >= 99.0", f"Percentage of valid numeric values in {c}",
                     "accuracy",
                     (f"{v} < 99.0", "numeric_accuracy", "'error'",
                      f"'Column {c} has ' || CAST(n - num_ok_{c} AS VARCHAR) || ' invalid numeric values'",
                      f"n - num_ok_{c}", c)))
    if typed:
        v = _rate("inconsistent")
        rows.append(("calculation_consistency", v, 99.0, f"{v} >= 99.0",
                     "Percentage of records with consistent calculations", "consistency",
                     ("inconsistent > 0", "calculation_consistency", "'error'",
                      "'Found ' || CAST(inconsistent AS VARCHAR) || ' records with inconsistent calculations'",
                      "inconsistent", ",".join(NUM4))))
    v = _rate("duplicates")
    rows.append(("uniqueness", v, 100.0, "duplicates = 0", "Percentage of unique records", "consistency",
                 ("duplicates > 0", "uniqueness", "'warning'",
                  "'Found ' || CAST(duplicates AS VARCHAR) || ' duplicate records'", "duplicates",
                  ",".join(SALES_COLUMNS))))
    if typed:
        for key, name, desc, col, msg in [
            ("bad_quantity", "quantity_validity", "Percentage of records with valid quantities (> 0)", "quantity",
             "' records with invalid quantities (<= 0)'"),
            ("bad_price", "price_validity", "Percentage of records with valid prices (>= 0)", "unit_price",
             "' records with negative prices'"),
            ("bad_discount", "discount_validity", "Percentage of records with valid discounts (0-100%)", "discount",
             "' records with invalid discounts'")]:
            rows.append((name, _rate(key), 100.0, f"{key} = 0", desc, "validity",
                         (f"{key} > 0", name, "'error'", f"'Found ' || CAST({key} AS VARCHAR) || {msg}", key, col)))
        v = _rate("old")
        rows.append(("timeliness", _rate("future"), 100.0, "future = 0",
                     "Percentage of records with valid dates (not in future)", "timeliness",
                     ("future > 0", "timeliness", "'error'",
                      "'Found ' || CAST(future AS VARCHAR) || ' records with future dates'", "future", "date")))
        rows.append(("freshness", v, 80.0, f"{v} >= 80.0", "Percentage of records from last 30 days", "timeliness",
                     (f"{v} < 80.0", "freshness", "'warning'",
                      f"'Only ' || printf('%.1f', {v}) || '% of data is from last 30 days'", "old", "date")))
    return rows


def _metrics_sql(cte: str, src: str, typed: bool) -> str:
    rows = _metric_rows(typed)
    parts = [f"SELECT CAST({i + 1} AS BIGINT) AS check_order, '{name}' AS name, {R(v)} AS value, "
             f"CAST({thr} AS DOUBLE) AS threshold, ({p}) AS passed, '{desc}' AS description, '{cat}' AS category FROM s"
             for i, (name, v, thr, p, desc, cat, _) in enumerate(rows)]
    return with_(cte, _stats_cte(src, typed)) + "\nUNION ALL\n".join(parts)


def _issues_sql(cte: str, src: str, typed: bool) -> str:
    parts = []
    for i, (_n, _v, _t, _p, _d, _c, issue) in enumerate(_metric_rows(typed)):
        if issue is None:
            continue
        cond, rule, sev, msg, aff, cols = issue
        parts.append(f"SELECT {i} AS ord, '{rule}' AS rule_name, {sev} AS severity, {msg} AS message, "
                     f"CAST({aff} AS BIGINT) AS affected_rows, '{cols}' AS affected_columns FROM s WHERE {cond}")
    return (with_(cte, _stats_cte(src, typed)) +
            "SELECT CAST(row_number() OVER (ORDER BY ord) AS BIGINT) AS issue_order, rule_name, severity, message, "
            "affected_rows, affected_columns FROM (" + "\nUNION ALL\n".join(parts) + ")")


def _score_sql(cte: str, src: str, typed: bool, as_written: bool = False) -> str:
    """Mean metric value per category, weighted; ``as_written`` takes the first token of
    the metric's name for its category."""
    rows = _metric_rows(typed)
    m = "\nUNION ALL\n".join(f"SELECT '{n.split('_')[0] if as_written else cat}' AS category, {v} AS value FROM s"
                              for (n, v, *_r, cat, _i) in rows)
    w = " UNION ALL ".join(f"SELECT '{k}' AS category, {wt} AS weight" for k, wt in DQ.WEIGHTS.items())
    return f"""(SELECT coalesce(sum(mv * weight), 0) FROM
      (SELECT category, avg(value) AS mv FROM ({m}) GROUP BY category) x JOIN ({w}) y USING (category))"""


def _issue_count_sql(typed: bool) -> str:
    conds = [issue[0] for (*_r, issue) in _metric_rows(typed) if issue is not None]
    return " + ".join(f"CAST(({c}) AS BIGINT)" for c in conds)


def _severity_sql(typed: bool) -> list[tuple[str, str]]:
    return [(issue[0], issue[2]) for (*_r, issue) in _metric_rows(typed) if issue is not None]


# ---------------------------------------------------------------------------------------
# DQ registrations
# ---------------------------------------------------------------------------------------
@register("quality_metrics", _metrics_sql(DIRTY_CTE, "sales_dirty", True))
def _quality_metrics(spark, sf_dir):
    return stable(_report(spark, sf_dir).metrics_df())


@register("quality_metrics_text", _metrics_sql(TEXT_CTE, "sales_text", False))
def _quality_metrics_text(spark, sf_dir):
    return stable(_report(spark, sf_dir, "text").metrics_df())


@register("quality_issues", _issues_sql(DIRTY_CTE, "sales_dirty", True))
def _quality_issues(spark, sf_dir):
    return stable(_report(spark, sf_dir).issues_df().drop("sample_data"))


@register("quality_score_as_written", with_(DIRTY_CTE, _stats_cte("sales_dirty", True)) + f"""
SELECT {R(_score_sql(DIRTY_CTE, 'sales_dirty', True, as_written=True))} AS overall_score FROM s""")
def _quality_score_as_written(spark, sf_dir):
    rep = DQ.run_all_checks(FX.sales_dirty(spark, sf_dir), FX.AS_OF, score_mode="as_written", samples=False)
    return stable(spark.createDataFrame([(rep.overall_score,)], "overall_score double"))


@register("quality_summary", with_(DIRTY_CTE, _stats_cte("sales_dirty", True)) + f"""
SELECT {AS_OF_SQL} AS timestamp, n AS total_records, CAST(6 AS BIGINT) AS total_columns,
       {R(R(_score_sql(DIRTY_CTE, 'sales_dirty', True), 2))} AS overall_score,
       {_issue_count_sql(True)} AS total_issues, CAST({len(_metric_rows(True))} AS BIGINT) AS total_metrics
FROM s""")
def _quality_summary(spark, sf_dir):
    return stable(_report(spark, sf_dir).summary_df())


def _summary_sql() -> str:
    return f"""SELECT n AS total_records, {R(R(_score_sql(DIRTY_CTE, 'sales_dirty', True), 2))} AS overall_score,
       {_issue_count_sql(True)} AS total_issues FROM s"""


@register("quality_report_nested", f"""SELECT m.name, m.value, m.threshold, m.passed, m.description, t.total_records, t.overall_score, t.total_issues
FROM ({_metrics_sql(DIRTY_CTE, "sales_dirty", True)}) m, ({with_(DIRTY_CTE, _stats_cte("sales_dirty", True))} {_summary_sql()}) t""")
def _quality_report_nested(spark, sf_dir):
    # DQ18: the one JSON document, read back by Spark.
    nested = ("summary struct<total_records:bigint,overall_score:double,total_issues:bigint>, "
              "metrics array<struct<name:string,value:double,threshold:double,passed:boolean,description:string>>")
    whole = _report(spark, sf_dir).to_json_df().select(F.from_json("report", nested).alias("r"))
    return stable(whole.select("r.summary.*", F.explode("r.metrics").alias("m")).select("m.*", "total_records", "overall_score", "total_issues"))


@register("quality_samples", with_(DIRTY_CTE) + f"""
SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, {R('total_sales', 6)} AS total_sales
FROM sales_dirty WHERE abs(total_sales - quantity * unit_price * (1 - discount)) > 0.01
ORDER BY date NULLS FIRST, product_id, quantity, unit_price, discount, total_sales LIMIT 3""")
def _quality_samples(spark, sf_dir):
    # DQ5: the sample of inconsistent rows that the issue carries.
    df = FX.sales_dirty(spark, sf_dir)
    issues = {x["rule_name"]: x for x in DQ.run_all_checks(df, FX.AS_OF).issues}
    rows = [tuple(r[c] for c in df.columns) for r in issues["calculation_consistency"]["sample_data"]]
    return stable(spark.createDataFrame(rows, df.schema), dp=6)


@register("quality_severity_breakdown", with_(DIRTY_CTE, _stats_cte("sales_dirty", True)) + """
SELECT severity, count(*) AS issues FROM (""" + "\nUNION ALL\n".join(
    f"SELECT {sev} AS severity FROM s WHERE {cond}" for cond, sev in _severity_sql(True)) + ") GROUP BY severity")
def _quality_severity(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return spark.createDataFrame(sorted(rep.severity_breakdown().items()), "severity string, issues bigint")


@register("quality_category_breakdown", with_(DIRTY_CTE, _stats_cte("sales_dirty", True)) + """
SELECT split_part(name, '_', 1) AS category, count(*) AS metrics FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{r[0]}' AS name FROM s" for r in _metric_rows(True)) + ") GROUP BY 1")
def _quality_category(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return spark.createDataFrame(sorted(rep.category_breakdown().items()), "category string, metrics bigint")


@register("failed_metrics", f"SELECT name, value, threshold FROM ({_metrics_sql(DIRTY_CTE, 'sales_dirty', True)}) "
                            "WHERE NOT passed")
def _failed_metrics(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return stable(rep.metrics_df().where(~F.col("passed")).select("name", "value", "threshold"))


@register("quality_gate", with_(DIRTY_CTE, _stats_cte("sales_dirty", True)) + f"""
SELECT {R(_score_sql(DIRTY_CTE, 'sales_dirty', True))} AS overall_score,
       {" + ".join(f"CAST(({c}) AND {s} = 'error' AS BIGINT)" for c, s in _severity_sql(True))} AS critical_issues,
       ({_score_sql(DIRTY_CTE, 'sales_dirty', True)}) >= 80.0
         AND ({" + ".join(f"CAST(({c}) AND {s} = 'error' AS BIGINT)" for c, s in _severity_sql(True))}) = 0
         AS acceptable
FROM s""")
def _quality_gate(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return stable(spark.createDataFrame([(rep.overall_score, len(rep.critical_issues()), rep.is_acceptable(80.0))],
                                        "overall_score double, critical_issues bigint, acceptable boolean"))


# ---------------------------------------------------------------------------------------
# RUL0-RUL11
# ---------------------------------------------------------------------------------------
def _rules_sql(cte: str = DIRTY_CTE, src: str = "sales_dirty") -> str:
    def sc(bad):
        return f"((n - ({bad})) / n) * 100"

    def issue(cond, msg):
        return f"CASE WHEN {cond} THEN {msg} END"

    rows = [
        ("required_fields_present", "error", 100.0, "true", "100.0", "NULL"),
        ("no_missing_critical_data", "error", 99.0,
         "((n * 2 - (md + mp)) / (n * 2)) * 100 >= 99.0", "((n * 2 - (md + mp)) / (n * 2)) * 100",
         "concat_ws(',', " + issue("md > 0", "'Field date has ' || CAST(md AS VARCHAR) || ' missing values'") + ", "
         + issue("mp > 0", "'Field product_id has ' || CAST(mp AS VARCHAR) || ' missing values'") + ")"),
        ("valid_date_format", "error", 99.0, f"{sc('n - date_ok')} >= 99.0", sc("n - date_ok"),
         issue("n - date_ok > 0", "'Found ' || CAST(n - date_ok AS VARCHAR) || ' invalid date values'")),
        ("valid_numeric_values", "error", 99.0,
         "((n * 4 - (" + " + ".join(f"(n - num_ok_{c})" for c in NUM4) + ")) / (n * 4)) * 100 >= 99.0",
         "((n * 4 - (" + " + ".join(f"(n - num_ok_{c})" for c in NUM4) + ")) / (n * 4)) * 100",
         "concat_ws(',', " + ", ".join(
             issue(f"n - num_ok_{c} > 0", f"'Field {c} has ' || CAST(n - num_ok_{c} AS VARCHAR) || "
                                          f"' invalid numeric values'") for c in NUM4) + ")"),
        ("calculation_consistency", "error", 99.0, f"{sc('inconsistent')} >= 99.0", sc("inconsistent"),
         issue("inconsistent > 0", "'Found ' || CAST(inconsistent AS VARCHAR) || ' records with inconsistent calculations'")),
        ("no_duplicates", "warning", 100.0, "duplicates = 0", sc("duplicates"),
         issue("duplicates > 0", "'Found ' || CAST(duplicates AS VARCHAR) || ' duplicate records'")),
        ("positive_quantities", "error", 100.0, "bad_quantity = 0", sc("bad_quantity"),
         issue("bad_quantity > 0", "'Found ' || CAST(bad_quantity AS VARCHAR) || ' records with non-positive quantities'")),
        ("valid_prices", "error", 100.0, "bad_price = 0", sc("bad_price"),
         issue("bad_price > 0", "'Found ' || CAST(bad_price AS VARCHAR) || ' records with negative prices'")),
        ("valid_discounts", "error", 100.0, "bad_discount = 0", sc("bad_discount"),
         issue("bad_discount > 0", "'Found ' || CAST(bad_discount AS VARCHAR) || ' records with invalid discounts'")),
        ("no_future_dates", "error", 100.0, "future = 0", sc("future"),
         issue("future > 0", "'Found ' || CAST(future AS VARCHAR) || ' records with future dates'")),
        ("recent_data", "warning", 80.0, f"{sc('old')} >= 80.0", sc("old"),
         issue("old > 0", "'Found ' || CAST(old AS VARCHAR) || ' records older than 30 days'")),
    ]
    parts = [f"SELECT CAST({i + 1} AS BIGINT) AS rule_order, '{name}' AS rule_name, '{sev}' AS severity, "
             f"CAST({thr} AS DOUBLE) AS threshold, ({passed}) AS passed, {R(score)} AS score, "
             f"coalesce({issues}, '') AS issues, CAST(NULL AS VARCHAR) AS error FROM s"
             for i, (name, sev, thr, passed, score, issues) in enumerate(rows)]
    extra = ("crit AS (SELECT count(*) FILTER (WHERE date IS NULL) AS md, "
             f"count(*) FILTER (WHERE product_id IS NULL) AS mp FROM {src}),\n"
             "s2 AS (SELECT * FROM s, crit)")
    return (with_(cte, _stats_cte(src, True), extra) +
            "\nUNION ALL\n".join(parts).replace(" FROM s", " FROM s2"))


@register("rule_results", _rules_sql())
def _rule_results(spark, sf_dir):
    return stable(RU.DataQualityRules().run_all(FX.sales_dirty(spark, sf_dir), FX.AS_OF))


# ---------------------------------------------------------------------------------------
# LEG1-LEG5
# ---------------------------------------------------------------------------------------
@register("legacy_completeness", with_(DIRTY_CTE) + "\nUNION ALL\n".join(
    f"SELECT count(*) AS total_rows, '{c}' AS \"column\", count(*) - count({c}) AS missing_values, "
    f"{R(f'(1.0 - CAST(count(*) - count({c}) AS DOUBLE) / count(*)) * 100.0')} AS completeness_percentage "
    f"FROM sales_dirty" for c in SALES_COLUMNS))
def _legacy_completeness(spark, sf_dir):
    return stable(L.completeness(FX.sales_dirty(spark, sf_dir)))


LEG_FLAGS = {
    "Positive Quantity": "quantity <= 0",
    "Total Sales Calculation": ("CASE WHEN total_sales = 0 THEN quantity * unit_price * (1 - discount) <> 0 "
                                "ELSE abs(total_sales - quantity * unit_price * (1 - discount)) / total_sales > 0.01 END"),
    "Discount Range": "discount < 0 OR discount > 1",
}


@register("business_rules", with_(DIRTY_CTE) + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT CAST({i + 1} AS BIGINT) AS rule_order, '{name}' AS rule, "
    f"count(*) FILTER (WHERE coalesce({cond}, false)) AS invalid_records FROM sales_dirty"
    for i, (name, cond) in enumerate(LEG_FLAGS.items())) + ") WHERE invalid_records > 0")
def _business_rules(spark, sf_dir):
    return stable(L.business_rules(FX.sales_dirty(spark, sf_dir)))


def _legacy_score_sql() -> str:
    comp = " + ".join(
        f"CASE WHEN (1.0 - CAST(count(*) - count({c}) AS DOUBLE) / count(*)) * 100.0 < 95 "
        f"THEN 100.0 - (1.0 - CAST(count(*) - count({c}) AS DOUBLE) / count(*)) * 100.0 ELSE 0 END"
        for c in SALES_COLUMNS)
    q = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in NUM4)
    b = ", ".join(f"{c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_hi"
                  for c in NUM4)
    outl = " + ".join(f"CAST(count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS DOUBLE) / count(*) * 100"
                      for c in NUM4)
    bad = " + ".join(f"count(*) FILTER (WHERE coalesce({cond}, false))" for cond in LEG_FLAGS.values())
    return with_(DIRTY_CTE) + f""",
cp AS (SELECT {comp} AS completeness_penalty FROM sales_dirty),
q AS (SELECT {q} FROM sales_dirty),
bnd AS (SELECT {b} FROM q),
op AS (SELECT {outl} AS outlier_penalty FROM sales_dirty, bnd),
br AS (SELECT count(*) AS valid_records, {bad} AS invalid_records FROM sales_dirty),
sc AS (SELECT *, CAST(invalid_records AS DOUBLE) / greatest(valid_records, 1) * 100.0 AS business_rule_penalty
       FROM cp, op, br),
fin AS (SELECT *, greatest(0.0, least(100.0 - completeness_penalty - outlier_penalty - business_rule_penalty,
                                       100.0)) AS data_quality_score FROM sc)
SELECT {R('completeness_penalty')} AS completeness_penalty, {R('outlier_penalty')} AS outlier_penalty,
       {R('business_rule_penalty')} AS business_rule_penalty, valid_records, invalid_records,
       {R('data_quality_score')} AS data_quality_score, data_quality_score < 80.0 AS alert
FROM fin"""


@register("legacy_quality_score", _legacy_score_sql())
def _legacy_quality_score(spark, sf_dir):
    return stable(L.quality_score(FX.sales_dirty(spark, sf_dir)))


def _legacy_report_sql() -> str:
    rows = [f"SELECT 'completeness' AS section, '{c}' AS name, {R(f'(1.0 - CAST(count(*) - count({c}) AS DOUBLE) / count(*)) * 100.0')} AS value "
            "FROM sales_dirty" for c in SALES_COLUMNS]
    rows += [f"SELECT 'outliers', '{c}', {R(f'CAST(count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS DOUBLE) / count(*) * 100')} "
             "FROM sales_dirty, bnd" for c in NUM4]
    rows += [f"SELECT 'business_rules', '{name}', {R(f'count(*) FILTER (WHERE coalesce({cond}, false))')} FROM sales_dirty"
             for name, cond in LEG_FLAGS.items()]
    score = _legacy_score_sql().split("SELECT " + R("completeness_penalty"))[0].removeprefix(with_(DIRTY_CTE))
    rows.append(f"SELECT 'score', 'data_quality_score', {R('data_quality_score')} FROM fin")
    return with_(DIRTY_CTE) + score + "\nUNION ALL\n".join(rows)


@register("legacy_report", _legacy_report_sql())
def _legacy_report(spark, sf_dir):
    return stable(L.comprehensive_report(FX.sales_dirty(spark, sf_dir)))


@register("business_rule_rows", with_(DIRTY_CTE) + "\nUNION ALL\n".join(
    f"SELECT date, product_id, quantity, {R('unit_price', 6)} AS unit_price, discount, {R('total_sales', 6)} AS total_sales, "
    f"{ROW_KEY} AS row_key, '{name}' AS rule FROM sales_dirty WHERE coalesce({cond}, false)"
    for name, cond in LEG_FLAGS.items()))
def _business_rule_rows(spark, sf_dir):
    return stable(L.business_rule_rows(FX.sales_dirty(spark, sf_dir), places=4), dp=6)


@register("rule_results_custom", with_(DIRTY_CTE) + f"""
SELECT CAST(1 AS BIGINT) AS rule_order, 'large_orders' AS rule_name, 'warning' AS severity, 90.0::DOUBLE AS threshold,
       (count(*) - count(*) FILTER (WHERE quantity > 45)) * 100.0 / count(*) >= 90.0 AS passed,
       {R('(count(*) - count(*) FILTER (WHERE quantity > 45)) / count(*) * 100.0')} AS score,
       CAST(count(*) FILTER (WHERE quantity > 45) AS VARCHAR) || ' large orders' AS issues, NULL::VARCHAR AS error
FROM sales_dirty""")
def _rule_results_custom(spark, sf_dir):
    """UDF1: a rule of the user's own, evaluated in the shared aggregate."""
    def check(df, context):
        def evaluate(v):
            score = (v["n"] - v["large"]) / v["n"] * 100.0
            return {"passed": score >= context["threshold"], "score": score, "issues": [f"{v['large']} large orders"]}
        return RU.RuleCheck({"n": F.count(F.lit(1)), "large": F.count_if(F.col("quantity") > 45)}, evaluate)
    rule = RU.QualityRule("large_orders", "Few orders are large", "warning", check, 90.0)
    return stable(RU.DataQualityRules([rule]).run_all(FX.sales_dirty(spark, sf_dir), FX.AS_OF))


# ---------------------------------------------------------------------------------------
# DQ17 / WIN4 / WIN5 / AGG12 / AGG13
# ---------------------------------------------------------------------------------------
@register("quality_history_summary", with_(HISTORY_CTE) + f"""
SELECT count(*) AS total_reports, min(timestamp) AS start, max(timestamp) AS "end",
       {R('avg(overall_score)')} AS avg_score, {R('min(overall_score)')} AS min_score,
       {R('max(overall_score)')} AS max_score, CAST(sum(n_issues) AS BIGINT) AS total_issues,
       CAST(sum(total_records) AS BIGINT) AS total_records
FROM quality_history""")
def _quality_history_summary(spark, sf_dir):
    return stable(H.summary_report(FX.quality_history(spark, sf_dir)))


@register("score_trend", with_(HISTORY_CTE) + f""",
a AS (SELECT count(*) AS n, arg_min(overall_score, timestamp) AS first, arg_max(overall_score, timestamp) AS last,
             var_pop(overall_score) AS var FROM quality_history)
SELECT CASE WHEN n >= 2 THEN CASE WHEN (last - first) / n > 0 THEN 'improving'
                                  WHEN (last - first) / n < 0 THEN 'declining' ELSE 'stable' END END AS direction,
       CASE WHEN n >= 2 THEN {R(R('(last - first) / n', 2))} END AS change_per_report,
       CASE WHEN n >= 2 THEN {R(R('last - first', 2))} END AS total_change,
       CASE WHEN n >= 2 THEN {R(R('var', 2))} END AS score_variance,
       CASE WHEN n < 2 THEN 'Insufficient data for trend analysis' END AS message
FROM a""")
def _score_trend(spark, sf_dir):
    return stable(H.score_trend(FX.quality_history(spark, sf_dir)))


@register("stable_periods", with_(HISTORY_CTE) + f""",
o AS (SELECT timestamp, overall_score, row_number() OVER (ORDER BY timestamp) - 1 AS idx,
             coalesce(CAST(abs(overall_score - lag(overall_score) OVER (ORDER BY timestamp)) > 5.0 AS INTEGER), 0)
               AS brk FROM quality_history),
i AS (SELECT *, sum(brk) OVER (ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM o)
SELECT CAST(min(idx) AS BIGINT) AS start_index, CAST(max(idx) AS BIGINT) AS end_index, count(*) AS duration,
       {R('avg(overall_score)')} AS avg_score
FROM i GROUP BY island HAVING count(*) > 1""")
def _stable_periods(spark, sf_dir):
    return stable(H.stable_periods(FX.quality_history(spark, sf_dir), 5.0))


RUNS_AS_OF = datetime(2024, 1, 30)


@register("pipeline_health", with_(RUNS_CTE) + f"""
SELECT max(timestamp) AS last_run_time,
       arg_max(CASE WHEN success THEN 'success' ELSE 'failed' END, timestamp) AS last_run_status,
       {R('arg_max(duration_seconds, timestamp)')} AS last_run_duration_seconds,
       count(*) FILTER (WHERE CAST(timestamp AS DATE) = DATE '2024-01-30') AS total_runs_today,
       count(*) FILTER (WHERE CAST(timestamp AS DATE) = DATE '2024-01-30' AND success) AS successful_runs_today,
       count(*) FILTER (WHERE CAST(timestamp AS DATE) = DATE '2024-01-30' AND NOT success) AS failed_runs_today,
       count(*) AS total_runs, count(*) FILTER (WHERE success) AS successful_runs,
       {R('coalesce(CAST(count(*) FILTER (WHERE success) AS DOUBLE) / count(*) * 100.0, 0.0)')} AS success_rate
FROM pipeline_runs""")
def _pipeline_health(spark, sf_dir):
    return stable(H.pipeline_health(FX.pipeline_runs(spark, sf_dir), RUNS_AS_OF))


_TAIL_SQL = """WITH logs AS (
  SELECT ts AS timestamp,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
         'events' AS logger, concat_ws(' ', event_type, props) AS message, CAST(user_id AS VARCHAR) AS user_id,
         event_id
  FROM events)
SELECT * FROM logs WHERE upper(level) = 'ERROR'
ORDER BY timestamp DESC, level, logger, message, user_id, event_id LIMIT 100"""


@register("log_tail", _TAIL_SQL)
def _log_tail(spark, sf_dir):
    return stable(H.tail_logs(FX.log_lines(spark, sf_dir), 100, "error"))


@register("log_tail_stored", _TAIL_SQL)
def _log_tail_stored(spark, sf_dir):
    path = Scratch(spark).folder("logs")
    H.store_logs(FX.log_lines(spark, sf_dir), path)
    lines = H.tail_stored(spark, path, 100, "error")
    return stable(lines)


# ---------------------------------------------------------------------------------------
# DQ12 / RUL0 by parts: the states of two appends, merged
# ---------------------------------------------------------------------------------------
def _store(spark, sf_dir, rules=None):
    df = FX.sales_dirty(spark, sf_dir)
    store = IN.QualityStore(Scratch(spark).folder("quality"), df, rules, FX.AS_OF)
    recent = F.col("date") >= F.lit("1997-01-01").cast("timestamp_ntz")
    for rows in (df.where(~F.coalesce(recent, F.lit(False))), df.where(recent)):
        store.add(rows, F.date_format("date", "yyyy"))
    return store


@register("quality_metrics_merged", _metrics_sql(DIRTY_CTE, "sales_dirty", True))
def _quality_metrics_merged(spark, sf_dir):
    return stable(_store(spark, sf_dir).report(FX.AS_OF).metrics_df())


@register("rule_results_merged", _rules_sql())
def _rule_results_merged(spark, sf_dir):
    return stable(_store(spark, sf_dir, RU.DataQualityRules()).rule_results())

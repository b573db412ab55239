from datetime import datetime

import pytest
from pyspark.sql import functions as F

from salesforge.operators import legacy as L
from salesforge.operators import quality as DQ
from salesforge.operators import rules as RU

from frames import AS_OF, SALES_DDL

F3_ROWS = [("2024-01-15", "P001", 10.0, 25.50, 0.1, 229.50),
           (None, "P002", 999999.0, 100.00, 0.0, 500.00),
           ("2024-01-16", "P003", 8.0, 75.25, 0.05, 767.55)]


def _f3(spark):
    return spark.createDataFrame(F3_ROWS, SALES_DDL).withColumn("date", F.col("date").cast("timestamp_ntz"))


def test_legacy_score_goldens(spark, f1):
    s1 = L.quality_score(f1).first()
    assert s1["data_quality_score"] == 100.0 and s1["alert"] is False
    s3 = L.quality_score(_f3(spark)).first()
    # 100 - 33.33 (one date of three missing) - 66.67 (two of three totals off) = 0
    assert s3["data_quality_score"] == pytest.approx(0.0, abs=1e-9)
    assert s3["alert"] is True
    assert s3["data_quality_score"] < s1["data_quality_score"]


def test_legacy_business_rules_count_each_rule(spark):
    rows = [("2024-01-15", "P001", -1.0, 10.0, 1.5, 100.0),  # quantity and discount: counted twice
            ("2024-01-15", "P002", 1.0, 10.0, 0.0, 0.0),     # zero total, calc 10 -> violation
            ("2024-01-15", "P003", 0.0, 10.0, 0.0, 0.0),     # zero total and calc 0 -> not
            ("2024-01-15", "P004", 1.0, 10.0, 0.0, -5.0)]    # negative total -> never
    df = spark.createDataFrame(rows, SALES_DDL)
    got = {r["rule"]: r["invalid_records"] for r in L.business_rules(df).collect()}
    assert got == {"Positive Quantity": 2, "Total Sales Calculation": 2, "Discount Range": 1}
    s = L.business_rules_summary(df).first()
    assert (s["valid_records"], s["invalid_records"]) == (4, 5)


def test_quality_report_clean_frame(spark, f1):
    rep = DQ.run_all_checks(f1, AS_OF)
    names = [m["name"] for m in rep.metrics]
    assert names[:7] == ["overall_completeness"] + [f"completeness_{c}" for c in f1.columns]
    assert all(m["passed"] for m in rep.metrics) and rep.issues == [] and rep.overall_score == 100.0
    rep = DQ.run_all_checks(f1, datetime(2024, 6, 1))  # nothing within 30 days any more
    assert [x["rule_name"] for x in rep.issues] == ["freshness"]
    assert rep.is_acceptable(70.0) is True  # only a warning
    assert rep.overall_score == pytest.approx(100.0 * 0.9 + 0.1 * 50.0)  # timeliness 100, freshness 0
    # As written, only completeness_* and timeliness carry weight: at most 35.
    assert DQ.overall_score(rep.metrics, "as_written") <= 35.0


def test_quality_report_low_quality(spark):
    rep = DQ.run_all_checks(_f3(spark), AS_OF)
    by = {m["name"]: m for m in rep.metrics}
    assert by["completeness_date"]["value"] == pytest.approx(200 / 3)
    assert by["completeness_date"]["passed"] is False
    issue = next(x for x in rep.issues if x["rule_name"] == "completeness")
    assert issue["severity"] == "error" and issue["message"] == "Column date has 1 null values (66.7% complete)"
    assert by["calculation_consistency"]["value"] == pytest.approx(100 / 3)
    assert rep.severity_breakdown()["error"] >= 2
    assert rep.category_breakdown()["completeness"] == 6
    d = rep.to_dict()
    assert d["summary"]["total_metrics"] == len(rep.metrics)


def test_duplicates_treat_null_equal(spark):
    rows = [("a", None), ("a", None), ("a", None), ("b", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert DQ.duplicate_count(df).first()["duplicates"] == 2


def test_duplicates_exact_despite_hash_collisions(spark):
    # a NULL adds nothing to the row hash, so these two rows hash alike but differ
    df = spark.createDataFrame([("a", None), (None, "a"), ("c", "d"), ("c", "d")], "x string, y string")
    assert DQ.duplicate_count(df).first()["duplicates"] == 1


def test_rule_engine_defaults_and_custom_rule(spark, f1):
    reg = RU.DataQualityRules()
    assert len(reg.get_enabled_rules()) == 11
    res = {r["rule_name"]: r for r in reg.run_all(f1, datetime(2024, 6, 1)).collect()}
    assert res["required_fields_present"]["passed"] and res["calculation_consistency"]["score"] == 100.0
    assert res["recent_data"]["passed"] is False and res["recent_data"]["issues"] == [
        "Found 4 records older than 30 days"]

    def code_rule(df, ctx):
        return RU.RuleCheck({"n": F.count(F.lit(1)), "bad": F.count_if(~F.col("product_id").rlike(r"^P\d{3}$"))},
                            lambda v: {"passed": v["bad"] == 0, "score": (v["n"] - v["bad"]) / v["n"] * 100,
                                       "issues": []})
    reg.add_rule(RU.QualityRule("product_code", "codes look like P###", "warning", code_rule, 100.0))
    reg.disable_rule("no_duplicates")
    assert reg.run_rule("no_duplicates", f1, AS_OF) == {"error": "Rule no_duplicates not found or disabled"}
    out = reg.run_rule("product_code", f1, AS_OF)
    assert out["passed"] is True and out["score"] == 100.0
    assert len(reg.run_all(f1, AS_OF).collect()) == 11

    def broken(df, ctx):
        raise RuntimeError("boom")
    reg.add_rule(RU.QualityRule("broken", "", "error", broken, 1.0))
    assert reg.run_rule("broken", f1, AS_OF) == {"rule_name": "broken", "passed": False, "error": "boom"}


def test_rules_missing_columns(spark, f1):
    reg = RU.DataQualityRules()
    res = {r["rule_name"]: r for r in reg.run_all(f1.drop("date", "discount"), datetime(2024, 2, 1)).collect()}
    assert res["required_fields_present"]["issues"] == ["Missing required fields: ['date']"]
    assert res["valid_date_format"]["issues"] == ["Date column not found"]
    assert res["valid_discounts"]["issues"] == ["Discount column not found"]
    assert res["calculation_consistency"]["issues"] == ["Missing fields required for calculation check"]

"""Canonical sales schema, stored-table projection and validation settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SALES_COLUMNS = ["date", "product_id", "quantity", "unit_price", "discount", "total_sales"]
NUMERIC_SALES_COLUMNS = ["quantity", "unit_price", "discount", "total_sales"]

# Required-column sets of each layer.
EXTRACT_REQUIRED = ["date", "product_id", "quantity", "unit_price"]
VALIDATION_REQUIRED = ["date", "product_id", "quantity", "unit_price", "discount", "total_sales"]
RULE_REQUIRED = ["date", "product_id", "quantity", "unit_price", "total_sales"]
UPLOAD_REQUIRED = ["date", "product_id", "quantity", "unit_price", "discount", "total_sales"]

# In flight: parsed sales rows.
SALES_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("quantity", T.DoubleType(), True),
    T.StructField("unit_price", T.DoubleType(), True),
    T.StructField("discount", T.DoubleType(), True),
    T.StructField("total_sales", T.DoubleType(), True),
])

# Raw landing schema: every field as text so bad values can be reported, not lost.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SALES_COLUMNS])

# Stored table ``sales_records``.
SALES_RECORDS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("product_id", T.IntegerType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DoubleType(), False),
    T.StructField("discount", T.DoubleType(), True),
    T.StructField("total_sales", T.DoubleType(), False),
    T.StructField("created_at", T.TimestampType(), True),
])

SALES_RECORDS_DDL = (
    "date DATE NOT NULL, product_id INT NOT NULL, quantity INT NOT NULL, "
    "unit_price DOUBLE NOT NULL, discount DOUBLE, total_sales DOUBLE NOT NULL, "
    "created_at TIMESTAMP"
)

PIPELINE_RUNS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("success", T.BooleanType(), True),
    T.StructField("duration_seconds", T.DoubleType(), True),
])

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("level", T.StringType(), True),
    T.StructField("logger", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("correlation_id", T.StringType(), True),
    T.StructField("pipeline_run_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
])


@dataclass
class ValidationConfig:
    """Extract-time gates (SCH1-SCH3).  Defaults are the reference's configured rules."""

    required_columns: list[str] = field(default_factory=lambda: list(EXTRACT_REQUIRED))
    type_checks: dict[str, str] = field(default_factory=lambda: {
        "quantity": "numeric", "unit_price": "numeric", "date": "datetime"})
    # Inclusive range checks.
    range_checks: dict[str, tuple[float, float]] = field(default_factory=lambda: {
        "quantity": (0, 1000), "unit_price": (0, 10000)})

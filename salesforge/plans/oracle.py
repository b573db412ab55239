"""SQL twins of the fixture views and the rounding convention, for the DuckDB oracle.

The registered Spark queries and these SQL strings must produce identical values, so
both sides round doubles the same way: scale, round half to even, unscale -- ``rint`` in
Spark and ``round_even(.., 0)`` in DuckDB perform the same IEEE operations.
"""

from __future__ import annotations

from collections.abc import Callable


def R(expr: str, dp: int | None = None) -> str:
    """SQL for ``round_half_even(expr, dp)``, or, without ``dp``, for
    ``round_significant(expr, 10)``."""
    if dp is not None:
        s = 10 ** dp
        return f"(round_even(CAST(({expr}) AS DOUBLE) * {s}, 0) / {s})"
    x = f"CAST(({expr}) AS DOUBLE)"
    sh = f"(9 - floor(log10(abs({x}))))"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 THEN {x} "
            f"WHEN {sh} >= 0 THEN round_even({x} * pow(10, {sh}), 0) / pow(10, {sh}) "
            f"ELSE round_even({x} / pow(10, -{sh}), 0) * pow(10, -{sh}) END)")


SALES_CTE = """sales AS (
  SELECT l_shipdate AS date,
         'P' || CAST(l_partkey AS VARCHAR) AS product_id,
         l_quantity AS quantity,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
         l_discount AS discount,
         l_extendedprice * (1 - l_discount) AS total_sales
  FROM lineitem)"""

INTRADAY_CTE = """sales AS (
  SELECT l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_orderkey % 60 AS INTEGER)) AS date,
         'P' || CAST(l_partkey AS VARCHAR) AS product_id, l_quantity AS quantity,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
         l_discount AS discount, l_extendedprice * (1 - l_discount) AS total_sales
  FROM lineitem)"""

_DIRTY_BASE = """dirty_base AS (
  SELECT CASE WHEN l_orderkey % 109 = 0 THEN NULL ELSE l_shipdate END AS date,
         'P' || CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL
              WHEN l_orderkey % 101 = 0 THEN -l_quantity
              ELSE l_quantity END AS quantity,
         CASE WHEN l_orderkey % 107 = 0 OR l_quantity = 0 THEN NULL
              ELSE l_extendedprice / l_quantity END AS unit_price,
         CASE WHEN l_orderkey % 103 = 0 THEN CAST(1.5 AS DOUBLE) ELSE l_discount END AS discount,
         CASE WHEN l_orderkey % 113 = 0 THEN l_extendedprice * (1 - l_discount) * CAST(1.5 AS DOUBLE)
              ELSE l_extendedprice * (1 - l_discount) END AS total_sales,
         l_orderkey AS k
  FROM lineitem),
dirty_rows AS (
  SELECT * FROM dirty_base
  UNION ALL
  SELECT * FROM dirty_base WHERE k % 89 = 0)"""

DIRTY_CTE = _DIRTY_BASE + """,
sales_dirty AS (
  SELECT date, product_id, quantity, unit_price, discount, total_sales FROM dirty_rows)"""

TEXT_CTE = _DIRTY_BASE + """,
sales_text AS (
  SELECT CASE WHEN k % 131 = 0 THEN 'invalid-date' WHEN k % 139 = 0 THEN strftime(date, '%m/%d/%Y')
              WHEN k % 149 = 0 THEN strftime(date, '%d %b %Y') ELSE CAST(date AS VARCHAR) END AS date,
         product_id,
         CASE WHEN k % 127 = 0 THEN 'ten' WHEN k % 137 = 0 THEN CAST(quantity AS VARCHAR) || 'd'
              ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CASE WHEN k % 151 = 0 AND unit_price IS NOT NULL THEN 'Infinity' ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
         CAST(discount AS VARCHAR) AS discount,
         CAST(total_sales AS VARCHAR) AS total_sales
  FROM dirty_rows)"""

HISTORY_CTE = """quality_history AS (
  SELECT date_trunc('day', ts) AS timestamp,
         count(*) AS total_records,
         20.0 + avg(value) AS overall_score,
         count(*) FILTER (WHERE event_type = 'error') AS n_issues,
         CAST(6 AS BIGINT) AS total_columns
  FROM events GROUP BY 1)"""

RUNS_CTE = """pipeline_runs AS (
  SELECT ts AS timestamp, event_type <> 'error' AS success, value AS duration_seconds
  FROM events)"""



def NUM(c: str) -> str:
    """SQL for ``number_text``."""
    x = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"(CASE WHEN isfinite({x}) THEN {x} END)"


def DATE(c: str) -> str:
    """SQL for ``date_text`` on the forms of the text view."""
    t = f"trim({c})"
    return f"coalesce(TRY_CAST({t} AS TIMESTAMP), try_strptime({t}, '%m/%d/%Y'), try_strptime({t}, '%d %b %Y'))"


def _grid(c: str) -> str:
    """A double as steps of four places."""
    return f"CAST(CAST(round_even({c} * 10000.0, 0) AS BIGINT) AS VARCHAR)"


def _exact(c: str) -> str:
    """A double's exact value: steps of 2^-20, and what is left in steps of 2^-82."""
    x, top = f"CAST({c} AS DOUBLE)", f"CAST({c} AS DOUBLE) * CAST({2 ** 20} AS DOUBLE)"
    rest = f"({top} - trunc({top})) * CAST({2 ** 62} AS DOUBLE)"
    return (f"CASE WHEN abs({x}) < {2 ** 42} AND (abs({x}) >= 1 / CAST({2 ** 30} AS DOUBLE) OR {x} = 0) "
            f"THEN CAST(CAST(trunc({top}) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST({rest} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END")


# The text of a value: a null mark or "=" and the value.
def _row_key(number: Callable[[str], str]) -> str:
    def cell(c: str) -> str:
        text = number(c) if c in ("quantity", "unit_price", "discount", "total_sales") else f"CAST({c} AS VARCHAR)"
        return f"'{c}' || coalesce('=' || {text}, '!')"
    return "md5(" + " || chr(31) || ".join(map(cell, ["date", "product_id", "quantity", "unit_price", "discount", "total_sales"])) + ")"


ROW_KEY, EXACT_ROW_KEY = _row_key(_grid), _row_key(_exact)


AS_OF_SQL = "TIMESTAMP '2001-06-30 00:00:00'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

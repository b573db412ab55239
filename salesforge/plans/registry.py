"""Registered queries: one per operator, each with its DuckDB SQL twin when one exists.

Every query reads the driver tables (through the fixture views) in full.  Registered
outputs round doubles half-to-even at a fixed number of places on both sides so that
summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesforge.functions.semantics import round_half_even, round_significant

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


SUM_DP = 4
SIG_DIGITS = 10


def _round(c, dp: int | None):
    return round_significant(c, SIG_DIGITS) if dp is None else round_half_even(c, dp)


def stable(df: DataFrame, dp: int | None = None, sums: tuple[str, ...] = (),
           sum_rows: tuple[str, ...] = ()) -> DataFrame:
    """Round double columns half-to-even and widen ints to bigint, arrays of strings to
    comma-joined text: one comparable shape for both engines.

    Money sums sit on an exact 4-place grid, so they are rounded at 4 places (``sums``
    columns; or, in long metric frames, the ``value`` of rows whose ``name`` is in
    ``sum_rows``); summation-order noise cannot move them off the grid point.  Other
    doubles (means, ratios) keep 10 significant digits (or ``dp`` fixed places), past
    the ties that means of grid values produce at fixed places.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = _round(c.cast("double"), SUM_DP if f.name in sums else dp)
            if f.name == "value" and sum_rows:
                c = F.when(F.col("name").isin(*sum_rows),
                           round_half_even(F.col("value").cast("double"), SUM_DP)).otherwise(c)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    # Importing the registration modules fills the tables above.
    from salesforge.plans import catalog  # noqa: F401

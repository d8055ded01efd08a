"""Numeric helpers whose results are identical in Spark and in a SQL oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(n, total) -> Column:
    """n / total as double; IEEE division of two integers is exact-rounded in
    every engine, so no further rounding is needed to compare."""
    n = F.col(n) if isinstance(n, str) else n
    total = F.col(total) if isinstance(total, str) else total
    return n.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))


def pct_label(n: str, total: str, places: int) -> Column:
    """Percent label of n / total with ``places`` decimals, rounded half up,
    e.g. 1234 of 10000 with places=2 -> '12.34 %'.

    Computed in integer arithmetic (T-SQL FORMAT 'P2'/'P4'), so the text does
    not depend on binary floating point. ``n`` and ``total`` are column names.
    """
    scale = 10 ** places
    scaled = (f"((CAST({n} AS BIGINT) * {200 * scale} + CAST({total} AS BIGINT)) "
              f"div (2 * CAST({total} AS BIGINT)))")
    return F.expr(f"concat(CAST({scaled} div {scale} AS STRING), '.', "
                  f"lpad(CAST(pmod({scaled}, {scale}) AS STRING), {places}, '0'), ' %')")


def pct_label_sql(n: str, total: str, places: int) -> str:
    scale = 10 ** places
    scaled = (f"((CAST({n} AS BIGINT) * {200 * scale} + CAST({total} AS BIGINT)) "
              f"// (2 * CAST({total} AS BIGINT)))")
    return (f"concat(CAST({scaled} // {scale} AS VARCHAR), '.', "
            f"lpad(CAST({scaled} % {scale} AS VARCHAR), {places}, '0'), ' %')")


def round_half_up(x: Column, places: int, to: str = "double") -> Column:
    """Round a double half up at ``places`` through a decimal(38,10) step."""
    return F.round(x.cast("decimal(38,10)"), places).cast(to if to != "decimal" else
                                                          f"decimal(38,{places})")


def round_half_up_sql(x: str, places: int, to: str = "DOUBLE") -> str:
    target = to if to != "decimal" else f"DECIMAL(38,{places})"
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {places}) AS {target})"


def money(x) -> Column:
    """Aggregated money as decimal(38,2), the same type in both engines."""
    x = F.col(x) if isinstance(x, str) else x
    return x.cast("decimal(38,2)")

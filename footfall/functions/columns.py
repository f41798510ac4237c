"""Column expressions shared by the plans; all built-in functions, so they stay in codegen."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.constants import AGES, CELL_SIZE, GRID_ID_FORMAT, HOURS, KINDS, SEXES


def month_start(c: Column | str) -> Column:
    """First day of the month of a date (MySQL DATE_FORMAT(d, '%Y-%m-01'))."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "MM")


def ym_text(c: Column | str) -> Column:
    """'yyyy-MM' text of a date."""
    return F.date_format(c, "yyyy-MM")


def month_number(c: Column | str) -> Column:
    """year * 12 + month: month differences between first-of-month dates are exact integer differences."""
    col = F.col(c) if isinstance(c, str) else c
    return F.year(col) * 12 + F.month(col)


def row_sum(cols: list[Column | str]) -> Column:
    """Row-wise sum; NULL if any term is NULL (no coalesce, as plain '+' does)."""
    return reduce(add, [F.col(c) if isinstance(c, str) else c for c in cols])


def lattice_index(coord: Column, origin: str, downward: bool = False, cell: int = CELL_SIZE) -> Column:
    """Cell index along one axis: (coord - origin) / cell, truncated toward zero; NULL where it is no int."""
    o = F.lit(Decimal(origin))
    offset = (o - coord) if downward else (coord - o)
    return (offset / F.lit(cell)).try_cast("int")


def grid_id_text(n: Column) -> Column:
    """'GRID' + zero padded number; wider numbers keep all their digits (not lpad, which cuts)."""
    return F.format_string(GRID_ID_FORMAT, n.cast("long"))


def id_number(grid_id: Column) -> Column:
    """Numeric suffix of a grid id, as a number (so GRID1000000 sorts after GRID999999); NULL for an id without one."""
    return F.regexp_extract(grid_id, r"([0-9]+)$", 1).try_cast("long")


def to_int_nonzero(c: Column, exact: bool = False) -> Column:
    """The feed's ``x != 0`` test: by default an integer compare (values in (-1, 1) count as zero).

    Text that is no number, and numbers beyond an int, are NULL and so pass neither test.
    """
    if exact:
        return c.try_cast("double") != 0
    return c.try_cast("double").try_cast("int") != 0


# SQL-text forms of the wide row-wise expressions: one selectExpr call builds all
# 24 (or 21) columns on the JVM side instead of hundreds of Column round trips.

def hour_sum_sql(template: str = "{kind}_t_{hour}") -> list[str]:
    """'h + w + v AS hh' for each hour (NULL if any term is NULL)."""
    return [" + ".join(f"`{template.format(kind=k, hour=h)}`" for k in KINDS) + f" AS `{h}`" for h in HOURS]


def _ratio_sql(num: str, total: str) -> str:
    return f"CASE WHEN ({total}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({num} AS DOUBLE) / CAST(({total}) AS DOUBLE) END"


def kind_total_sql(kind: str) -> str:
    """Sum of the 14 sex/age counts of one kind."""
    return " + ".join(f"`{kind}_{s}_{a}`" for s in SEXES for a in AGES)


def female_ratio_sql() -> list[str]:
    """The 21 ratios {k}_w_{age}_r = female count / 14-count total (0 when the total is 0)."""
    return [f"{_ratio_sql(f'`{k}_w_{a}`', kind_total_sql(k))} AS `{k}_w_{a}_r`" for k in KINDS for a in AGES]


def female_counts_sql() -> list[str]:
    """Per kind: its 14 sex/age counts as one array of doubles, the seven female ones first."""
    return [f"array({', '.join(f'CAST(`{k}_{s}_{a}` AS DOUBLE)' for s in ('w', 'm') for a in AGES)}) AS `_{k}`" for k in KINDS]


def female_share_sql() -> list[str]:
    """Per kind, from its array of counts: female counts / all counts (0 when those are 0, NULL with a NULL count)."""
    total = "aggregate({c}, CAST(0 AS DOUBLE), (n, x) -> n + x)"
    return [f"{_ratio_sql(total.format(c=f'slice(`_{k}`, 1, {len(AGES)})'), total.format(c=f'`_{k}`'))} AS `{k}_fml_r`"
            for k in KINDS]

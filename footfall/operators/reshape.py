"""Wide-to-long reshaping of the hourly feeds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.constants import HOURS, KINDS


def melt(df: DataFrame, id_vars: Iterable[str], value_vars: Iterable[str], var_name: str = "variable",
         value_name: str = "value") -> DataFrame:
    """Wide to long: one row per (id_vars, value column); NULL values are kept.

    ``DataFrame.unpivot`` plans as a single Expand, no array of structs per row.
    """
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def stack_kinds(df: DataFrame, id_vars: list[str], kinds: list[str] = KINDS, hours: list[str] = HOURS,
                hour_name: str = "tm", template: str = "{kind}_t_{hour}", suffix: str = "_pop") -> DataFrame:
    """One ``stack`` of 24 rows carrying all kinds side by side: (ids, tm, h_pop, w_pop, v_pop).

    Replaces one unpivot per kind followed by joins on the five keys: a single
    Generate, no shuffle.
    """
    parts = []
    for hour in hours:
        parts.append(f"'{hour}'")
        parts.extend(f"`{template.format(kind=k, hour=hour)}`" for k in kinds)
    names = ", ".join([hour_name] + [f"{k}{suffix}" for k in kinds])
    expr = f"stack({len(hours)}, {', '.join(parts)}) AS ({names})"
    return df.select(*[F.col(c) for c in id_vars], F.expr(expr))


def hours_packed(df: DataFrame, id_vars: list[str], kinds: list[str] = KINDS, hours: list[str] = HOURS,
                 hour_name: str = "tm", template: str = "{kind}_t_{hour}", suffix: str = "_pop",
                 name: str = "_hours") -> DataFrame:
    """(ids, array of (tm, h_pop, w_pop, v_pop)): the rows of ``stack_kinds`` in one column, to explode later."""
    parts = []
    for hour in hours:
        values = ", ".join(f"'{k}{suffix}', `{template.format(kind=k, hour=hour)}`" for k in kinds)
        parts.append(f"named_struct('{hour_name}', '{hour}', {values})")
    return df.selectExpr(*[f"`{c}`" for c in id_vars], f"array({', '.join(parts)}) AS `{name}`")

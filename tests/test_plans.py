"""Plan shapes that carry the scale properties: pushdown, pruning, where shuffles happen."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from footfall.catalog import QUERIES, _sex_age, _time_pop
from footfall.plans import population as po
from footfall.sources import fixtures as fx


def plan_text(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_q1_scan_is_pruned_and_filtered(static_plans):
    text = plan_text(QUERIES["user_movement"](static_plans, SF_SMALL))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:" in text
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    # dedup to (customer, month) before the customer-keyed window, then the month totals: three exchanges
    nodes = [ln for ln in text.splitlines() if re.match(r"^\(\d+\) ", ln)]
    assert sum(" Exchange" in ln for ln in nodes) == 3


def test_hour_stack_comes_after_the_joins(static_plans):
    df = po.female_population(_time_pop(static_plans, SF_SMALL), _sex_age(static_plans, SF_SMALL),
                              fx.fx_ic_grid(static_plans, SF_SMALL))
    lines = plan_text(df, "simple").splitlines()
    stack = next(i for i, ln in enumerate(lines) if "Generate explode" in ln)
    joins = [i for i, ln in enumerate(lines) if "Join" in ln]
    assert joins and all(i > stack for i in joins)  # joins are below (before) the stack in the tree


def test_district_prefix_reaches_the_scan(static_plans):
    text = plan_text(po.in_districts(_time_pop(static_plans, SF_SMALL), ["28237"]))
    assert "StringStartsWith(hcode,28237)" in text


def test_wide_hours_are_joined_once(spark):
    """The grid is joined to the narrow shares: between the scan and the hour stack, the packed hours pass one join."""
    feeds = [spark.createDataFrame([], ", ".join(f"{c} {'decimal(18,6)' if 'coord' in c else 'string' if c in po.FEED_KEYS else 'double'}"
                                                 for c in [*po.FEED_KEYS, *values])) for values in (fx.HOUR_COLUMNS, fx.SEX_AGE_COLUMNS)]
    grid = spark.createDataFrame([], "grid_id string, mtr_no string, cnt_x_crd decimal(18,6), cnt_y_crd decimal(18,6), admd_cd string")
    lines = po.female_population(*feeds, grid)._jdf.queryExecution().analyzed().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    at = next(i for i, x in enumerate(lines) if "AS _hours" in x)
    joins, top = 0, depth[at]
    for i in range(at, -1, -1):
        if depth[i] < top:
            joins, top = joins + ("Join" in lines[i]), depth[i]
    assert joins == 1

"""Exact percentiles per group without gathering a group into one task.

``percentile_disc`` / ``median`` hold every distinct value of a group in one aggregation buffer, and a
per-group window sorts the whole group in one task. A snapshot group holds every active user, so both are
unbounded. Here a value is found by bracketing its rank:

1. one aggregation: the values n of each group and, for each probability, two values of a ``percentile_approx``
   sketch (fixed size, aggregated map-side) a little below and above it. The sketch's rank error is at most
   n / accuracy, so the wanted rank lies between them;
2. over the rows again: the rows below each bracket are counted, and those inside one, about 8 / accuracy of them, are
   counted per value. Both are partially aggregated before the shuffle;
3. a running count inside each bracket gives the value at the rank;
4. groups with a rank outside its bracket are looked through again with wider brackets, in the end with the whole range.

Several columns can be ranked in the same passes. The rows are read three times, so callers pass a frame that is cheap to
read (a table, or pieces to unfold), not a join. The result is exact: the sketch only decides what is counted and
what is ranked. Values must be exact as doubles (doubles, integers below 2^53). Discrete ranks equal
``percentile_disc`` / ``approxQuantile(..., 0)``; interpolation follows Spark's ``percentile`` / ``median`` formula.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.scratch import Scope, scope as own_scope

#: Sketch resolution: brackets span 8 / ACCURACY of a group's ranks.
ACCURACY = 1000
#: How much wider the brackets of a second look are.
WIDER = 16


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str | list[str],
    probs: list[float],
    names: list[str],
    interpolate: bool = False,
    accuracy: int = ACCURACY,
    reach: float | None = None,
    scope: Scope | None = None,
) -> DataFrame:
    """One row per group present in ``df``: keys + one column per value column and probability.

    ``value``: one column or several of the same type; ``names`` holds the probabilities of the first, then of the next.
    NULL values are skipped; groups without any value have no row (callers left-join them from their calendar to get
    NULL, like a global aggregate over no rows), a column without values in a group that has others is NULL.
    ``reach``: how far brackets reach to either side at first, as a share of the ranks.
    """
    values = [value] if isinstance(value, str) else list(value)
    if len(names) != len(values) * len(probs):
        raise ValueError("one output name per value column and probability")
    if len({df.schema[v].dataType for v in values}) != 1:
        raise ValueError("value columns of one type")
    scope = scope or own_scope(df.sparkSession)
    rows = df.where(F.coalesce(*values).isNotNull()).select(*keys, *values)
    reach = 4 / accuracy if reach is None else reach
    found, todo = None, rows
    while True:
        picked = scope.table(_picked(scope, todo, keys, values, probs, interpolate, accuracy, reach), "ranked")
        open_groups = picked.where("_open")
        done = picked.where("NOT _open")
        found = done if found is None else found.unionByName(done)
        if open_groups.isEmpty():
            break
        todo = rows.join(open_groups.select(*keys), keys, "left_semi")
        reach = max(reach, 1 / accuracy) * WIDER
    return found.select(*keys, *_results(values, probs, names, interpolate))


def _picked(scope: Scope, rows: DataFrame, keys: list[str], values: list[str], probs: list[float], interpolate: bool,
            accuracy: int, reach: float) -> DataFrame:
    """Per group: ``_n<k>`` (values of the k-th column), ``_r1_<i>`` and ``_r2_<i>`` (the values at the ranks of the i-th
    value column and probability), and ``_open``, whether a rank lies outside its bracket."""
    whole, each = reach >= 1, range(len(values) * len(probs))
    ends = [min(1.0, max(0.0, p + s)) for p in probs for s in (-reach, reach)]
    aggs = []
    for k, v in enumerate(values):
        aggs += [F.count(v).alias(f"_n{k}"), F.array(F.min(v), F.max(v)).alias(f"_e{k}") if whole
                 else F.percentile_approx(v, ends, accuracy).alias(f"_e{k}")]
    cols = [f"_n{k}" for k in range(len(values))]
    for i in each:
        k, j = divmod(i, len(probs))
        n, edge, exact = F.col(f"_n{k}"), F.col(f"_e{k}"), F.lit(Decimal(str(probs[j])))  # exact decimal arithmetic for the rank itself
        at = (n - 1) * exact
        first = F.floor(at) + 1 if interpolate else F.greatest(F.ceil(n * exact), F.lit(1))
        last = F.ceil(at) + 1 if interpolate else first
        cols += [edge[0 if whole else 2 * j].alias(f"_lo{i}"), edge[1 if whole else 2 * j + 1].alias(f"_hi{i}"),
                 first.cast("long").alias(f"_rank1_{i}"), last.cast("long").alias(f"_rank2_{i}")]
    sketch = scope.table(rows.groupBy(*keys).agg(*aggs).select(*keys, *cols), "sketch")        # one row per group

    # the rows below a bracket are counted; the few inside any bracket are counted per value
    met = rows.join(sketch.select(*keys, *[f"_{e}{i}" for i in each for e in ("lo", "hi")]), keys)
    value_of = [F.col(values[i // len(probs)]) for i in each]
    below = met.groupBy(*keys).agg(*[F.count_if(v < F.col(f"_lo{i}")).alias(f"_below{i}") for i, v in enumerate(value_of)])
    hits = [v.between(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i, v in enumerate(value_of)]
    in_any = F.coalesce(hits[0], F.lit(False))
    for h in hits[1:]:
        in_any = in_any | F.coalesce(h, F.lit(False))
    marks = F.array(*[F.when(h, F.struct(F.lit(i).alias("_i"), v.alias("_v"))) for i, (h, v) in enumerate(zip(hits, value_of))])
    inside = met.where(in_any).select(*keys, F.explode(marks).alias("_b")).where("_b IS NOT NULL")
    counted = inside.groupBy(*keys, F.col("_b._i").alias("_i"), F.col("_b._v").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))

    order = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_upto", F.sum("_c").over(order))
    known = sketch.select(*keys, *cols[:len(values)], *[f"_rank{r}_{i}" for i in each for r in (1, 2)]).join(below, keys)
    placed = known.join(ranked, keys, "left")
    picks, missing = [], F.lit(False)
    for i in each:
        end = F.col(f"_below{i}") + F.col("_upto")
        for r in (1, 2):
            rank = F.col(f"_rank{r}_{i}")
            holds = (F.col("_i") == i) & (end - F.col("_c") < rank) & (rank <= end)
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_r{r}_{i}"))
            missing = missing | (F.col(f"_r{r}_{i}").isNull() & (F.col(f"_n{i // len(probs)}") > 0))
    counts = [F.max(f"_n{k}").alias(f"_n{k}") for k in range(len(values))]
    return placed.groupBy(*keys).agg(*counts, *picks).withColumn("_open", missing)


def _results(values: list[str], probs: list[float], names: list[str], interpolate: bool) -> list:
    if not interpolate:
        return [F.col(f"_r1_{i}").alias(name) for i, name in enumerate(names)]
    # Spark's percentile: (higher - pos) * lowerValue + (pos - lower) * higherValue, pos = (n - 1) * p
    cols = []
    for i, name in enumerate(names):
        pos = (F.col(f"_n{i // len(probs)}") - 1).cast("double") * F.lit(float(probs[i % len(probs)]))
        lower, higher = F.floor(pos), F.ceil(pos)
        lo_v, hi_v = F.col(f"_r1_{i}").cast("double"), F.col(f"_r2_{i}").cast("double")
        interp = (higher - pos) * lo_v + (pos - lower) * hi_v
        cols.append(F.when((higher == lower) | (lo_v == hi_v), lo_v).otherwise(interp).alias(name))
    return cols

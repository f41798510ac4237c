"""Month lists from folders, the ledger, emptied months, quarantined lines, ids over ranges, heavy keys, job groups."""

import contextlib
import io
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from footfall import catalog, jobs
from footfall.operators.ids import assign_sequential_ids
from footfall.operators.skew import heavy_keys
from footfall.scratch import Scope, scope
from footfall.sources import feeds
from footfall.sources import fixtures as fx

ORDERS = "cust_id long, ordr_de date, ordr_key long, pt_stdr_ym string"


@pytest.fixture()
def run(spark):
    with scope(spark) as s:
        yield s


def rows_of(months: dict):
    return [(i, date(int(m[:4]), int(m[4:]), 1 + i % 28) if m else None, i, m) for m, n in months.items() for i in range(n)]


def write(spark, path, months: dict, mode="append"):
    spark.createDataFrame(rows_of(months), ORDERS).write.mode(mode).partitionBy(jobs.PARTITION).parquet(path)


def folder(spark, path, month):
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{jobs.PARTITION}={month}")
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def months_in(spark, path):
    return {r[0]: r[1] for r in spark.read.schema(ORDERS).parquet(path).groupBy(jobs.PARTITION).count().collect()}


def noted(spark, path):
    return sorted((r["month"], r["rows"]) for r in jobs.ledger_of(spark, path).entries().collect())


def schema_of(spark):
    return spark.createDataFrame([], ORDERS).schema


def test_month_list_reads_no_data(spark, run):
    source = run.path("src")
    write(spark, source, {"202001": 3, "202002": 2, None: 4})
    where, fs = folder(spark, source, "202003")
    fs.mkdirs(where)                                                        # a month without any file
    broken, fs = folder(spark, source, "202004")
    fs.mkdirs(broken)
    out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(broken, "part-0.parquet"))
    out.close()                                                             # a file that no reader could open
    found = jobs.path_partitions(spark, source, schema_of(spark))
    assert sorted(r[0] for r in found.collect()) == [f"pt_stdr_ym={m}" for m in ("202001", "202002", "202003", "202004", "__HIVE_DEFAULT_PARTITION__")]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        found.explain("formatted")
    assert "Scan parquet" not in text.getvalue()
    assert jobs.path_partitions(spark, run.path("nowhere"), schema_of(spark)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("months_of_")]
    months = jobs.months_to_load(found, jobs.path_partitions(spark, run.path("nowhere"), schema_of(spark)), gaps=True)
    assert sorted(r[0] for r in months.collect()) == ["202001", "202002", "202003", "202004"]           # the default partition is no month


def test_empty_and_emptied_months(spark, run):
    source, target = run.path("src"), run.path("dst")
    write(spark, source, {"202001": 3, "202002": 2})
    where, fs = folder(spark, source, "202003")
    fs.mkdirs(where)
    assert jobs.load_new_months(spark, source, target, schema_of(spark)) == 3
    assert months_in(spark, target) == {"202001": 3, "202002": 2}
    assert noted(spark, target) == [("202001", 3), ("202002", 2), ("202003", 0)]
    assert jobs.load_new_months(spark, source, target, schema_of(spark), gaps=True) == 0            # the empty month is loaded
    gone, fs = folder(spark, source, "202002")
    fs.delete(gone, True)
    jobs.reload_months(spark, source, target, schema_of(spark), ["202002"])
    assert months_in(spark, target) == {"202001": 3} and noted(spark, target)[-2:] == [("202002", 2), ("202003", 0)]
    assert ("202002", 0) in noted(spark, target)
    write(spark, source, {"202002": 5})
    jobs.reload_months(spark, source, target, schema_of(spark), ["202002"])
    assert months_in(spark, target) == {"202001": 3, "202002": 5}


def test_a_run_killed_between_write_and_note(spark, run, monkeypatch):
    source, target = run.path("src"), run.path("dst")
    write(spark, source, {"202001": 3})
    jobs.load_new_months(spark, source, target, schema_of(spark))
    write(spark, source, {"202002": 4})
    with monkeypatch.context() as m:
        m.setattr(jobs.Ledger, "note", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            jobs.load_new_months(spark, source, target, schema_of(spark))
    assert months_in(spark, target) == {"202001": 3, "202002": 4} and noted(spark, target) == [("202001", 3)]
    assert jobs.load_new_months(spark, source, target, schema_of(spark)) == 1
    assert months_in(spark, target) == {"202001": 3, "202002": 4} and noted(spark, target) == [("202001", 3), ("202002", 4)]
    assert jobs.load_new_months(spark, source, target, schema_of(spark)) == 0


def test_a_target_from_before_the_ledger(spark, run):
    source, target = run.path("src"), run.path("dst")
    write(spark, source, {"202001": 3, "202002": 2})
    write(spark, target, {"202001": 3})
    assert jobs.load_new_months(spark, source, target, schema_of(spark)) == 1
    assert noted(spark, target) == [("202001", None), ("202002", 2)]


def test_catalog_months_that_are_empty_now(spark, run):
    names = ("fx_ledger_source", "fx_ledger_target")
    try:
        for name, months in zip(names, ({"202001": 2, "202002": 3}, {"202001": 2})):
            df = spark.createDataFrame(rows_of(months), ORDERS)
            df.write.partitionBy(jobs.PARTITION).option("path", run.path(name)).saveAsTable(name)
        spark.sql(f"ALTER TABLE {names[0]} ADD PARTITION ({jobs.PARTITION}='202003')")
        ledger = run.path("ledger")
        assert jobs.load_new_months_table(spark, *names, ledger_path=ledger) == 2
        entries = jobs.Ledger(spark, ledger).entries().collect()
        assert sorted((r["month"], r["rows"]) for r in entries) == [("202001", None), ("202002", 3), ("202003", 0)]
        assert jobs.load_new_months_table(spark, *names, ledger_path=ledger) == 0
        assert spark.table(names[1]).count() == 5
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_malformed_lines_are_kept_apart(spark, run):
    names = [f.name for f in feeds.TIME_POP_SCHEMA.fields]
    good = ["20240101", "2823751000", "1", "2", *["1.5"] * 72, "B"]
    path, quarantine = run.path("feed"), run.path("quarantine")
    text = ["|".join(names), "|".join(good), "|".join(good[:-3]), "|".join([*good, "more"])]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
    read = feeds.reconciled_feed(spark, path, feeds.TIME_POP_SCHEMA, quarantine)
    assert [list(r) for r in read.collect()] == [good]
    assert read.select("hcode").collect()[0][0] == "2823751000" and read.count() == 1
    kept = spark.read.parquet(quarantine).orderBy("fields").collect()
    assert [(r["key"], r["line"], r["fields"]) for r in kept] == [("20240101", text[2], 74), ("20240101", text[3], 78)]
    counts = feeds.feed_counts(spark, path, feeds.TIME_POP_SCHEMA).first()
    assert (counts.good_lines, counts.bad_lines, counts.feed_file) == (1, 2, kept[0]["feed_file"])
    with pytest.raises(Exception, match="MALFORMED"):
        feeds.read_feed(spark, path, feeds.TIME_POP_SCHEMA).select("hcode").collect()


def test_damaged_feed_has_no_task_for_a_month(spark, run, monkeypatch):
    # one month, its rows in many parts: no part waits for another, and every file begins with the header
    names = [f.name for f in feeds.TIME_POP_SCHEMA.fields]
    rows = spark.range(0, 400, 1, 6).select(
        F.lit("20240101").alias("std_ymd"), F.lit("2823751000").alias("hcode"),
        (F.col("id") * 50).cast("decimal(18,6)").alias("x_coord"), F.lit(1).cast("decimal(18,6)").alias("y_coord"),
        *[F.col("id").cast("decimal(18,2)").alias(c) for c in feeds.TIME_VALUES], F.lit(None).cast("string").alias("block_cd"))
    monkeypatch.setattr(catalog, "_time_pop", lambda spark, sf_dir: rows)
    path = run.path("damaged")
    catalog._damaged_feed(spark, "", path)
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_name").alias("f"))
    per_file = lines.groupBy("f").agg(F.count_if(F.col("value") == "|".join(names)).alias("heads"), F.count("*").alias("n")).collect()
    assert [r.heads for r in per_file] == [1] * 6 and max(r.n for r in per_file) < 100
    read = feeds.reconciled_feed(spark, f"{path}/*.csv", feeds.TIME_POP_SCHEMA, run.path("quarantine"))
    assert {len(r) for r in read.collect()} == {77} and read.count() == 320
    assert read.where("x_coord = '100.000000'").select("v_t_23", "block_cd").collect() == [("0.25000", None)]


def test_wide_feeds_are_dealt_by_their_rows(spark, monkeypatch):
    # a task makes so many wide rows at most: more events are dealt to more tasks
    monkeypatch.setattr(fx, "PIVOT_ROWS", 20)
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    feed = fx.fx_time_pop(spark, SF_SMALL)
    assert feed.rdd.getNumPartitions() == -(-n // 20) > 8
    monkeypatch.setattr(fx, "PIVOT_ROWS", 1 << 40)
    assert sorted(feed.collect()) == sorted(fx.fx_time_pop(spark, SF_SMALL).collect())


@pytest.mark.parametrize("cells", [[(r, 0) for r in range(300)], [(0, c) for c in range(300)], [(r % 40, r // 40 + r % 3 * 100) for r in range(280)], []])
def test_ids_over_range_partitions(spark, run, cells):
    df = spark.createDataFrame(cells, "row_no int, clm_no int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assign_sequential_ids(df, "row_no", "clm_no", F.lit(7), scope=run)
        got = [(r.row_no, r.clm_no, r.seq) for r in numbered.orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == [(r, c, 8 + i) for i, (r, c) in enumerate(sorted(cells))]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        numbered.explain("formatted")
    assert "Window" not in text.getvalue() and "SinglePartition" not in text.getvalue()


def test_heavy_keys_behind_a_skewed_partition(spark):
    rows = [(1,)] * 1000 + [(i,) for i in range(2, 1500)] + [(None,)] * 400
    dealt = spark.createDataFrame(rows, "k int").repartitionById(4, F.pmod(F.coalesce("k", F.lit(2)), F.lit(4)).cast("int"))
    got = {(r.partition_id, r.key): r for r in heavy_keys(dealt, "k", 0.05).collect()}
    assert {k: r.n_rows for k, r in got.items()} == {(1, 1): 1000, (2, None): 400}
    for r in got.values():
        assert abs(r.sketch_rows - r.n_rows) <= r.error_rows and r.error_rows < 0.05 * r.partition_rows
    with pytest.raises(ValueError):
        heavy_keys(dealt, "k", 0.0)


def test_ids_and_partitions_without_a_number(spark):
    from footfall.functions.columns import id_number
    from footfall.plans.intake import new_months
    got = spark.createDataFrame([("GRID000012",), ("none",), (None,)], "g string").select(id_number(F.col("g")).alias("n")).collect()
    assert [r.n for r in got] == [12, None, None]
    parts = spark.createDataFrame([("pt_stdr_ym=202201",), ("pt_stdr_ym=__HIVE_DEFAULT_PARTITION__",)], "partition string")
    assert [r[0] for r in new_months(parts, parts.limit(0)).collect()] == [202201]


def test_steps_keep_the_callers_group(spark):
    sc = spark.sparkContext
    sc.setJobGroup("mine", "my work")
    try:
        with jobs.job_step(spark, "step", "inner"):
            assert sc.getLocalProperty("spark.jobGroup.id") == "mine"
        assert (sc.getLocalProperty("spark.jobGroup.id"), sc.getLocalProperty("spark.job.description")) == ("mine", "my work")
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            sc.setLocalProperty(name, None)
    with jobs.job_step(spark, "step", "inner"):
        assert sc.getLocalProperty("spark.jobGroup.id") == "step"
    assert sc.getLocalProperty("spark.jobGroup.id") is None


def test_the_grid_intake_leaves_no_scratch(spark):
    import os

    from conftest import SF_SMALL
    from footfall.catalog import QUERIES
    base = spark.conf.get("spark.checkpoint.dir")
    files = lambda: sum(f.endswith(".parquet") for _, _, fs in os.walk(base) for f in fs)
    counts = []
    for _ in range(2):
        assert QUERIES["grid_intake"](spark, SF_SMALL).count() > 0
        counts.append(files())
    assert counts[0] == counts[1] and Decimal(counts[0]) > 0


def test_colocated_feeds_join_where_they_lie(spark):
    from footfall.catalog import QUERIES
    from footfall.sources import colocated

    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.enabled": "false", colocated.CO_PARTITIONED[0]: colocated.CO_PARTITIONED[1]}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        got = QUERIES["female_population_colocated"](spark, SF_SMALL)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 2, plan
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3, plan
        want = QUERIES["female_population"](spark, SF_SMALL)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_feeds(spark):
    """Hourly feed, sex/age feed and grid: one cell met twice, one on no grid, one without coordinates."""
    cells = [("20240101", "2823751000", Decimal(x) if x else None, Decimal(y) if y else None)
             for x, y in (("25", "25"), ("25", "25"), ("75", "25"), (None, "25"))]
    coords = "std_ymd string, hcode string, x_coord decimal(18,6), y_coord decimal(18,6)"

    def feed(rows, names, given):
        return spark.createDataFrame([r + tuple(Decimal(given.get(n, 0)) for n in names) for r in rows],
                                     ", ".join([coords, *(f"{n} decimal(18,2)" for n in names)]))

    grid = spark.createDataFrame([("GRID000001", "0,0", Decimal(25), Decimal(25), "2823751000"), ("GRID000002", "0,2", None, Decimal(25), "2823751000")],
                                 "grid_id string, mtr_no string, x_coord decimal(18,6), y_coord decimal(18,6), admd_cd string")
    return {"time_pop": feed(cells, fx.HOUR_COLUMNS, {"h_t_07": 8, "w_t_07": 2, "v_t_23": 4}),
            "sex_age": feed(cells[1:], fx.SEX_AGE_COLUMNS, {"h_w_10": 3, "h_m_20": 1, "w_w_70": 1, "w_m_70": 1}), "grid": grid}


def test_feeds_are_merged_however_small_their_files(spark, run):
    """A feed's compressed files say little of its rows in memory: feeds, stored or not, do not pass the driver."""
    from footfall.plans import population as po
    from footfall.sources import colocated

    frames = small_feeds(spark)
    kept = colocated.stored(spark, frames, run.path("cells"), f"merged_{run.folder.rpartition('/')[2].replace('-', '_')}", buckets=2)
    centres = {"x_coord": "cnt_x_crd", "y_coord": "cnt_y_crd"}
    want = [("20240101", "07", "GRID000001", 7.0, "28237")] * 2
    for tables, merged in ((kept, 2), (frames, 1)):
        got = po.female_population(tables["time_pop"], tables["sex_age"], tables["grid"].withColumnsRenamed(centres))
        assert sorted(tuple(r) for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
        joins = [ln for ln in plan.split("\n") if "Join" in ln]
        assert len(joins) == 2 and all("SortMergeJoin" in ln for ln in joins[:merged]), plan


def test_buckets_follow_the_rows(spark):
    from footfall.sources.colocated import buckets_for

    assert buckets_for(spark.range(10)) == 8
    assert buckets_for(spark.range(1000), bucket_rows=10) == 128 and buckets_for(spark.range(0), least=1) == 1


def test_grid_intake_makes_its_facts_once(spark, monkeypatch):
    made, calls, table, run = [], [], Scope.table, jobs.run_grid_intake
    monkeypatch.setattr(Scope, "table", lambda self, df, name: made.append(name) or table(self, df, name))
    monkeypatch.setattr(jobs, "run_grid_intake", lambda *a: calls.append(a) or run(*a))
    facts = catalog.q_grid_intake(spark, SF_SMALL)
    assert "cell-days" in made and "facts" not in made        # 24 rows a cell-day are not stored beside the target
    noted = jobs.ledger_of(spark, calls[0][3]).entries().select("month", "rows").collect()
    written = facts.groupBy(jobs.PARTITION).count().collect()
    assert noted and {tuple(r) for r in noted} == {tuple(r) for r in written}

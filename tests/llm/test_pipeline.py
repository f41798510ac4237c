"""The corpus pipeline against a brute-force version of its stages."""

from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from footfall.llm.common import written
from footfall.llm.queries import ORACLE, QUERIES

from .conftest import SF_MID, awkward_rows
from .test_dedup import slow_groups, slow_print


def test_every_operator_is_registered():
    names = list(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(ORACLE) <= set(names)


def test_stages_on_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    frames = {"": docs}
    for name, stage in cp.STAGES:
        docs = written(spark, stage(spark, docs, SF_MID), name)
        frames[name] = docs
    for name, _ in cp.STAGES[:-1]:
        assert frames[name].columns == frames[""].columns
    raw = frames["language_id"].toPandas()
    assert len(raw) >= 0.97 * frames[""].count()
    kept = raw.sort_values("doc_id").drop_duplicates("text", keep="last")
    assert sorted(frames["exact_dedup"].toPandas().doc_id) == sorted(kept.doc_id)
    kept = kept.reset_index(drop=True)
    groups = slow_groups([slow_print(t) for t in kept.text], 2)
    least = defaultdict(list)
    for i, g in zip(kept.doc_id, groups):
        least[g].append(i)
    assert sorted(frames["simhash_dedup"].toPandas().doc_id) == sorted(min(x) for x in least.values())
    last = frames["sentencepiece"].toPandas()
    assert last.parity.all() and last.round_trip.all()
    whole = cp.run(spark, SF_MID)
    assert whole.select(*frames[""].columns).exceptAll(docs.select(*frames[""].columns)).count() == 0
    assert whole.count() == docs.count()


def test_stages_on_awkward_and_empty_tables(spark, clashing, empty):
    for start in (clashing, empty):
        docs = start
        for name, stage in cp.STAGES:
            before = docs
            docs = written(spark, stage(spark, docs, ""), name)
            if name != cp.STAGES[-1][0]:
                assert docs.columns == before.columns
        assert (docs.count() > 0) == (start is clashing)
        assert docs.where(~F.col("round_trip")).count() == 0

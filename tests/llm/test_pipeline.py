"""The pipeline on the smallest tables, each stage against what it must do to its own input."""

import importlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftspark.llm.chains import repeated_passages
from liftspark.llm.common import stored
from liftspark.llm.quality import quality_verdicts
from liftspark.llm.tokens import Encoder, default_vocabulary
from tests.llm import test_chains, test_nearjoin
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_mixture_shards import targets

SF = "/root/testdata/sf0.001"
pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
        if len(out) <= len(pipeline.STAGES):
            assert out[-1].schema.names == docs.schema.names and [f.dataType for f in out[-1].schema] == [f.dataType for f in docs.schema]
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(spark, stages):
    kept = quality_verdicts(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).filter("kept")
    assert rows_of(stages[1]).keys() == rows_of(kept).keys()
    before = rows_of(stages[0])
    assert all(r == before[i] for i, r in rows_of(stages[1]).items())


def test_near_duplicates(stages):
    classes = test_nearjoin.brute([(r.doc_id, r.text) for r in stages[1].collect()])
    assert rows_of(stages[2]).keys() == {c for _, c, _, _ in classes}


def test_repeats(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    repeated = test_chains.brute([(i, r.text) for i, r in before.items()])
    assert test_chains.brute([(i, r.text) for i, r in after.items()]) == {}
    found = test_chains.covered(repeated_passages(stages[2]).collect())
    assert all(not words - found[i] for i, words in repeated.items())
    for i, r in before.items():
        if i not in after:  # every word lay in some passage
            assert found[i] == set(range(len(r.text.split())))
        elif after[i].text != r.text:
            words = iter(r.text.split())
            assert all(w in words for w in after[i].text.split()) and after[i].n_chars == len(after[i].text)


def test_repeats_whose_phrases_are_common(spark):
    """An edited passage goes though each of its phrases lies in more documents than a phrase leads to at once."""
    docs = spark.createDataFrame(test_chains.phrases_elsewhere(random.Random(12), 9), SCHEMA).repartition(5)
    before, after = rows_of(docs), rows_of(pipeline.repeats_removed(spark, docs, SF))
    assert len(after[10_001].text.split()) <= 26 < len(before[10_001].text.split())
    assert all(after[i].text == r.text for i, r in before.items() if i != 10_001)


def test_mix(stages):
    size, taken = {}, {}
    for r in stages[3].collect():
        size[r.source] = size.get(r.source, 0) + len(r.text.split())
    for r in stages[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    for s, t in targets(size).items():
        assert t - 1 - 1e-6 <= taken.get(s, 0) <= t + 1e-6


def test_pack(stages):
    enc = Encoder(default_vocabulary())
    want = sum(len(np.frombuffer(enc.ids(r.text), np.uint16)) + 1 for r in stages[4].collect())
    assert stages[5].groupBy().sum("length").first()[0] == want


def test_one_row_of_each_group(spark):
    """Rows go, not ids: a unique text of a repeated id stays, and of repeated rows, null ids too, one stays."""
    rng = random.Random(12)
    a, b, c, d, e = (prose(rng, 80) for _ in range(5))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, d), (None, d), (None, e), (9, e + " end"), (4, None), (4, None), (5, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).withColumn("row", F.lit("clash")).repartition(4)
    out = pipeline.one_of_each_group(spark, docs, SF)
    assert out.dtypes == docs.dtypes
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (None, d), (9, e + " end"), (4, None), (4, None), (5, ""), (None, None)], key=str)


def test_all_stages_take_awkward_rows(spark, awkward, nothing):
    """Nulls in any column, empty and long texts, repeated rows, names that clash, and an empty table."""
    for docs in (awkward, nothing):
        now = docs
        for name, stage in pipeline.STAGES:
            now = stored(stage(spark, now, SF), name)
            if name != "pack":
                assert now.columns == docs.columns
        assert (now.count() > 0) == (docs is awkward)
    kept = pipeline.quality_rules(spark, awkward, SF)
    one = stored(pipeline.one_of_each_group(spark, kept, SF), "one")
    texts = [r.text for r in one.collect()]
    assert len(texts) == len(set(texts)) > 5 and {r.doc_id for r in one.collect()} <= {r.doc_id for r in kept.collect()}


def test_entry_has_all(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
    assert names["pipeline"](spark, SF).columns == pipeline.run(spark, SF).columns

import random

from pyspark.sql import functions as F

from liftspark.llm.quality import quality_filter, quality_verdicts
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_words import brute

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "threshold", "kept"]


def test_awkward(awkward, awkward_rows, labels):
    rows = quality_verdicts(awkward, labels).collect()
    assert rows[0].asDict().keys() == set(COLUMNS)
    order = lambda r: (r[0] is None, r[0], *r[1:])
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=order)
    assert got == sorted(((r[0], *brute(r[1])) for r in awkward_rows), key=order)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.llr >= r.threshold)


def test_empty(nothing, labels, awkward):
    assert quality_verdicts(nothing, labels).count() == 0
    unlabelled = quality_verdicts(awkward, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed and r.llr == 0 for r in unlabelled)


def test_parts_junk_from_prose(spark):
    """Junk whose words are all different, told by what comes with them; labels for half of the documents."""
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(400):
        junk = i % 5 == 0
        text = prose(rng, 120)
        rows.append((i, " ".join(w + "!!" for w in text.split()) if junk else text, "en", "a", 1))
        if i % 2:
            marks.append((i, int(not junk)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = spark.createDataFrame(marks, "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_verdicts(docs, marks).collect()}
    assert all(kept[i] == (i % 5 != 0) for i in kept)
    filtered = quality_filter(docs, marks)
    assert filtered.columns == docs.columns
    assert {r.doc_id for r in filtered.collect()} == {i for i in kept if kept[i]}


def test_filter_agrees_with_verdicts(awkward, labels):
    kept = quality_verdicts(awkward, labels).filter("kept").groupBy("doc_id").count()
    filtered = quality_filter(awkward, labels)
    assert filtered.columns == awkward.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, filtered.groupBy("doc_id").agg(F.count("*").alias("count")).collect()))

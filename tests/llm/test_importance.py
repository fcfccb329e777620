"""Importance resampling against plain counting."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
import pytest

from liftspark.llm import importance as I
from liftspark.llm.queries import ORACLES, QUERIES
from tests import oracle

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def grams(text, order):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, order=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    """Sorted (doc_id, n_words, n_features, weight, score, drawn) and the order in which documents are drawn."""
    s, t = (Counter(crc32(g.encode()) % buckets for x in texts for g in grams(x, order)) for texts in ([x for _, x in docs], target))
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        found = grams(text, order)
        weight = 0
        for g in found:
            b = crc32(g.encode()) % buckets
            weight += math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    return out, fit[: percent * len(fit) // 100]


def check(rows, docs, target, **options):
    want, drawn = brute(docs, target, **options)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    ranked = sorted((r for r in rows if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == [(r[4], r[0]) for r in drawn]


def test_query_against_its_sql(spark):
    name = "op12_importance_resampling"
    assert oracle.compare(spark, oracle.connect(SF), QUERIES[name], ORACLES[name], SF) == ("", 200)


@pytest.mark.parametrize("order", [1, 3])
def test_against_brute_force(spark, order):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = I.resample(spark.read.parquet(f"{SF}/documents.parquet"), target, order=order, percent=25, buckets=977).collect()
    check(rows, docs, [r.text for r in target.collect()], order=order, percent=25, buckets=977)


@pytest.mark.parametrize("block", [3, 1 << 17])
def test_no_run_crosses_texts(block, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", block)
    texts = ["a b", None, "", "c", "Ärger ÄRGER d\x00e F_g", "  ", "h i j k"]
    n, found = I.features(pa.array(texts), 3, 1 << 32)
    assert n.tolist() == [len(words(t)) for t in texts]
    for k, (bucket, owner) in enumerate(found, 1):
        want = [(crc32(" ".join(w[i : i + k]).encode()), d) for d, w in enumerate(map(words, texts)) for i in range(len(w) - k + 1)]
        assert list(zip(bucket.tolist(), owner.tolist())) == want


def test_awkward_rows(spark, awkward, awkward_rows):
    docs, target = [(r[0], r[1]) for r in awkward_rows], ["kaberlodan mi Ras", None, ""]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (0, 10, 50, 100):
        check(I.resample(awkward, frame, percent=percent).collect(), docs, target, percent=percent)


def test_many_equal_rows(spark):
    docs = [(7, "one two three " * 9)] * 300 + [(None, "four five " * 12)] * 100 + [(i, "six " * 30) for i in range(40)]
    rows = I.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame([("six",)], "text string"), percent=60)
    check(rows.collect(), docs, ["six"], percent=60)


def test_empty_tables(spark, nothing, awkward, awkward_rows):
    assert I.resample(nothing, nothing).count() == 0
    check(I.resample(awkward, nothing).collect(), [(r[0], r[1]) for r in awkward_rows], [])

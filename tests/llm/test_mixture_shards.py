import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from liftspark.llm import mixture, shards
from liftspark.llm.mixture import mix_sources, mixed_documents
from liftspark.llm.shards import greedy, shard_documents, smallest_capacity
from tests.llm.conftest import SCHEMA, prose


def targets(sizes, weights=(3, 1, 2), share=1.5):
    """By handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out = dict.fromkeys(names, 0.0)
    full, rest = set(), share * sum(sizes.values())
    while rest > 1e-9 and len(full) < len(names):
        total, more = sum(w[s] for s in names if s not in full), 0.0
        for s in names:
            if s not in full:
                out[s] += rest * w[s] / total
                if out[s] >= 2 * sizes[s]:
                    more += out[s] - 2 * sizes[s]
                    out[s] = 2.0 * sizes[s]
                    full.add(s)
        rest = more
    return out


@pytest.mark.parametrize("rows_per_range", [8192, 3])
def test_awkward_mix(awkward, awkward_rows, rows_per_range):
    rows = mix_sources(awkward, rows_per_range=rows_per_range).collect()
    assert len(rows) == len(awkward_rows)
    size, taken = Counter(), Counter()
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = targets(size)
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    for s in size:
        assert want[s] - 1 - 1e-6 <= taken[s] <= want[s] + 1e-6
    again = mix_sources(awkward.repartition(7), rows_per_range=rows_per_range).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == Counter((r.doc_id, r.size, r.taken) for r in rows)


def test_mix_agrees_with_sql_and_its_documents(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(0, 60)), "en", rng.choice(["a", "a", "a", "b", "c", None]), 1) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in mix_sources(docs, rows_per_range=5).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert got == {r[0]: r[1:] for r in con.execute(mixture.SQL).fetchall()}
    mixed = mixed_documents(docs, rows_per_range=5)
    assert mixed.columns == docs.columns
    words, text = Counter(), dict((r[0], r[1]) for r in rows)
    for r in mixed.collect():
        n = len(r.text.split())
        assert r.text.split() == text[r.doc_id].split()[:n]
        words[r.doc_id] += n
    assert words == Counter({i: t[3] for i, t in got.items() if t[3]})


def test_mixed_awkward(awkward):
    taken = Counter()
    for r in mix_sources(awkward).collect():
        taken[r.source] += r.taken
    mixed = mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    got = Counter()
    for r in mixed.collect():
        got[r.source] += len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r.text)])
    for s in taken:  # equal rows on a cut are cut alike
        assert abs(got[s] - taken[s]) <= 240


def test_empty_mix(nothing, spark):
    assert mix_sources(nothing).count() == 0 and mixed_documents(nothing).count() == 0
    rows = mix_sources(spark.createDataFrame([(1, None, None, "a", 1), (2, " ", None, None, 1)], SCHEMA)).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0), (0.0, 0)]


def check_shards(rows, source_rows, n=8):
    assert len(rows) == len(source_rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in source_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = defaultdict(set)
    for r in rows:
        texts[r.text_crc32, r.size].add(r.shard)
    return slots, texts


def test_awkward_shards(awkward, awkward_rows):
    _, texts = check_shards(shard_documents(awkward, rows_per_range=2).collect(), awkward_rows)
    null_and_empty = {(0, 1)}  # null and empty texts have one size and sum, but are different texts
    assert all(len(s) == 1 for k, s in texts.items() if k not in null_and_empty)


def test_capacity_is_smallest(spark, monkeypatch):
    """The same largest shard as by dynamic programming over groups in hash order, from very coarse ranges on."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(shards, "FIRST_BITS", 2)
    monkeypatch.setattr(shards, "MORE_BITS", 1)
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.choice([1, 3, 10, 40])) if i % 3 else "hot " * 9, "en", "a", 1) for i in range(150)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = shard_documents(docs)
    check_shards(got.collect(), rows)
    held = got.groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [
        r.size
        for r in docs.groupBy(F.xxhash64("text", F.col("text").isNull()).alias("h"))
        .agg(F.sum(F.octet_length("text") + 1).alias("size"))
        .orderBy("h")
        .collect()
    ]
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(8):
        best = [0] + [min(max(best[i], sum(sizes[i:j])) for i in range(j + 1)) for j in range(1, len(sizes) + 1)]
    assert max(r.b for r in held) == best[-1]


def test_greedy():
    prefix = [0, 5, 6, 9, 20]
    assert greedy(prefix, 2, 10) is None and greedy(prefix, 2, 11) == [3, 4]
    assert smallest_capacity(prefix, 2, 11, 20) == 11


def test_empty_shards(nothing, spark):
    assert shard_documents(nothing).count() == 0
    one = shard_documents(spark.createDataFrame([(1, None, None, "a", 1)], SCHEMA)).collect()
    assert [(r.size, r.shard, r.slot) for r in one] == [(1, 0, 0)]

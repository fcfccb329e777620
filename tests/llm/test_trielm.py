import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from liftspark.llm import trielm
from liftspark.llm.eliasfano import EliasFano, joined, parted
from liftspark.llm.trielm import Trie, score_texts

numbers = st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**56 - 1)), max_size=60)


@settings(max_examples=300, deadline=None)
@given(numbers, numbers)
def test_elias_fano(values, asked):
    values = np.sort(np.array(values, np.uint64))
    ef = EliasFano(EliasFano.encode(values))
    assert ef.values().tolist() == values.tolist()
    asked = np.array([*asked, *values.tolist()], np.uint64)
    assert ef.successor(asked).tolist() == np.searchsorted(values, asked).tolist()


def test_elias_fano_is_small():
    values = np.sort(np.random.default_rng(1).integers(0, 2**40, 100_000).astype(np.uint64))
    assert len(EliasFano.encode(values)) < 100_000 * 4  # 24 bits of information, 64 as they are


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 30)), st.integers(1, 1000), max_size=40))
def test_trie(counts):
    key = lambda p: (p[0] << trielm.HALF) | p[1]
    keys = np.array(sorted(map(key, counts)), np.uint64)
    by_key = {key(p): n for p, n in counts.items()}
    trie = Trie(Trie.build(keys, np.array([by_key[k] for k in keys.tolist()], np.int64)))
    every = np.array([key((a, b)) for a in range(7) for b in range(32)], np.uint64)
    for k, code in zip(every.tolist(), trie.find(every).tolist()):
        assert code == (round(math.log10(by_key[k]) * trielm.STEPS) if k in by_key else -1)


def test_joined():
    parts = [b"", b"abc", bytes(16)]
    assert [bytes(p) for p in parted(joined(parts))] == parts


def brute(rows):
    fold = {c: c + 32 for c in range(65, 91)}
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold)), None] for _, t, *_ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows]
    c, p = Counter(), Counter()
    for w, h in zip(tokens, held):
        if not h:
            c.update(w)
            p.update(zip([None, *w[:-1]], w))
    n, v = sum(c.values()), len(c)
    g, u = ((sum(x == 1 for x in y.values()) + 1) / (n + 2) for y in (p, c))
    out = []
    for (i, *_), w, h in zip(rows, tokens, held):
        base = sum(math.log10((c[a] + 0.1) / (n + 0.1 * (v + 1))) for a in w)
        score = 0.0
        for a, b in zip([None, *w[:-1]], w):
            if p[a, b]:
                score += math.log10((1 - g) * p[a, b] / c[a])
            else:
                score += math.log10(g * ((1 - u) * c[b] / n if c[b] else u))
        out.append((i, h, len(w), sum(c[a] > 0 for a in w), n, base, score))
    return out


@pytest.mark.parametrize("size", [8_000_000, 3000])
def test_awkward(awkward, awkward_rows, monkeypatch, size):
    monkeypatch.setattr(trielm, "PAIR_SHARD_BYTES", size)
    monkeypatch.setattr(trielm, "WORD_SHARD_BYTES", size)
    rows = [*awkward_rows, *((3000 + i, f"alpha beta w{i} Alpha beta", "en", "a", 1) for i in range(40))]
    spark = awkward.sparkSession
    got = score_texts(awkward.select("doc_id", "text", "n").union(spark.createDataFrame([(*r[:2], "x") for r in rows[len(awkward_rows) :]], "doc_id long, text string, n string")))
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got.collect()), key=order), sorted(brute(rows), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert any(w[1] for w in want)
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and abs(g[6] - w[6]) <= 1.5 * g[2] / trielm.STEPS


def test_empty(nothing, spark):
    assert score_texts(nothing).count() == 0
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    alone = score_texts(spark.createDataFrame([(i, "a b", "", "", 1) for i in ids], "doc_id long, text string, lang string, source string, n_chars long"))
    assert {(r.n_known, r.train_tokens, r.base_score) for r in alone.collect()} == {(0, 0, 0.0)}

import random
import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from liftspark.llm import nearjoin
from liftspark.llm.graph import components
from liftspark.llm.nearjoin import near_duplicates
from tests.llm.conftest import SCHEMA, prose


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=Fraction(4, 5)):
    """(doc_id, class, links, links with other sets) of each row; ids unique."""
    sets = {i: sets_of(t) for i, t in rows}
    root = {i: i for i in sets}
    links, texts = dict.fromkeys(sets, 0), {i: set() for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        a, b = sets[i], sets[j]
        n = len(a & b)
        if n and n >= threshold * (len(a) + len(b) - n):
            links[i] += 1
            links[j] += 1
            if a != b:
                texts[i].add(b)
                texts[j].add(a)
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted((i, find(i), links[i], len(texts[i])) for i in sets)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


@pytest.mark.parametrize("block", [512, 7])
def test_against_brute_force(spark, monkeypatch, block):
    """A large group, small ones, exact copies, texts of other spacing and short texts; also in blocks of 7."""
    monkeypatch.setattr(nearjoin, "BLOCK_NODES", block)
    rng = random.Random(2)
    rows = [prose(rng, rng.randint(1, 300)) for _ in range(60)]
    base = prose(rng, 200)
    rows += [edited(rng, base, rng.randint(0, 6)) for _ in range(70)]
    for _ in range(15):
        text = prose(rng, rng.randint(6, 150))
        rows += [edited(rng, text, k) for k in range(rng.randint(1, 4))] + [text, text.replace(" ", "\n ")]
    rows += ["a b", "a  b", "a b c"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in near_duplicates(docs).collect())
    assert got == brute(rows)


def test_awkward(awkward, awkward_rows):
    out = near_duplicates(awkward)
    assert out.columns == ["doc_id", "class_id", "n_links", "n_text_links"]
    rows = sorted((tuple(r) for r in out.collect()), key=str)
    assert len(rows) == len(awkward_rows)
    of = {r[0]: r[1:] for r in rows}
    assert of[None] == (None, 0, 0)
    assert [of[i] for i in (1, 2, 3)] == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]
    assert of[5] == (5, 1, 1) and of[6] == (5, 1, 1)
    assert of[10] == (10, 4, 1) and of[11] == (10, 4, 1) and of[12] == (10, 4, 1)


def test_empty(nothing, spark):
    assert near_duplicates(nothing).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None, "", "", 0), (2, "", "", "", 0)], SCHEMA)).count() == 2


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100)]
    rng.shuffle(chain)
    links = [*chain, (500, 200), (500, 300), (7, 7), (None, 3), (200, 500), (-4, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(101), 0), **dict.fromkeys((200, 300, 500, -4), -4)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_detection_and_depth():
    assert nearjoin.detection(0.8, nearjoin.DEPTH, nearjoin.TREES) > 0.9999
    assert nearjoin.detection(0.9, 9) > nearjoin.detection(0.8, 9) > nearjoin.detection(0.8, 10)


@pytest.mark.parametrize(("threshold", "swaps"), [("0.2", 42), ("0.5", 14)])
def test_low_thresholds(spark, threshold, swaps):
    """Pairs near a low threshold are found: depths shorten although nothing was found at first."""
    rng = random.Random(int(float(threshold) * 10))
    rows = []
    for _ in range(40):
        text = prose(rng, 200)
        rows += [text, edited(rng, text, swaps)]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r.n_links for r in near_duplicates(docs, threshold=threshold, target_recall=0.99).collect()}
    want = {i: n for i, _, n, _ in brute(rows, Fraction(threshold))}
    assert sum(want.values()) >= 60 and sum(got.values()) >= 0.97 * sum(want.values())
    assert all(got[i] <= n for i, n in want.items())


def test_prefixes_are_shortened(spark, monkeypatch):
    """From a depth at which little is found, the search goes on until the target."""
    monkeypatch.setattr(nearjoin, "DEPTH", 60)
    rng = random.Random(4)
    rows = []
    for _ in range(12):
        text = prose(rng, 150)
        rows += [text, edited(rng, text, 2), edited(rng, text, 3)]
    rows = list(enumerate(rows))
    seen = []
    real = nearjoin.candidate_links
    monkeypatch.setattr(nearjoin, "candidate_links", lambda nodes, depth: seen.append(depth) or real(nodes, max(1, depth // 8)))
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    monkeypatch.setattr(nearjoin, "TARGET_RECALL", 0.9)
    got = sorted(tuple(r) for r in near_duplicates(docs, target_recall=0.0).collect())
    assert seen == [60] and got == brute(rows)


@pytest.mark.parametrize("most", [1, 40, 10**6])
def test_links_of_buckets(monkeypatch, most):
    """Packed prefixes give links that connect each bucket, and few rows are held, in whatever order and parts they come."""
    monkeypatch.setattr(nearjoin, "PART_ROWS", most)
    rng = np.random.default_rng(3)
    rows = np.stack([rng.integers(-30, 30, 3000), rng.integers(0, 200, 3000)], 1)
    want = {p: set(rows[rows[:, 0] == p, 1].tolist()) for p in set(rows[:, 0].tolist())}
    held = []
    monkeypatch.setattr(nearjoin, "bucket_links", lambda r, real=nearjoin.bucket_links: held.append(len(r)) or real(r))
    for p, nodes in want.items():
        own = rows[rows[:, 0] == p]
        batches = [pa.record_batch([pa.array([0, 0]), pa.array([x.tobytes() for x in np.array_split(part, 2)])], names=["part", "rows"]) for part in np.array_split(own, 4)]
        root = {i: i for i in nodes}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for batch in nearjoin._links(iter(batches)):
            for key, head in zip(*(c.to_pylist() for c in batch.columns)):
                assert head < key
                root[find(key)] = find(head)
        assert len({find(i) for i in nodes}) == 1
    assert max(held) <= 2 * most + 30 or most == 10**6


def test_prefixes_are_shuffled_packed(spark):
    """A shuffled row for each part and 2,048 nodes, not one for each prefix."""
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, prose(rng, 30), "en", "a", 1) for i in range(500)], SCHEMA).coalesce(1)
    signed = docs.select("doc_id", "text").mapInArrow(lambda b: nearjoin._sign(5, b), "doc_id long, key long, n long, sig binary")
    batches = [b for b in signed.mapInArrow(lambda b: nearjoin._prefixes(8, 7, b), "part long, rows binary").collect()]
    assert sorted(r.part for r in batches) == list(range(7)) and sum(len(r.rows) for r in batches) == 500 * nearjoin.TREES * 16

"""SimHash components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from liftspark.llm import simhash as S
from liftspark.llm.queries import QUERIES
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def plain(text, words=3):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, threshold=3):
    """The component of each fingerprint, by all pairs."""
    fps, out = sorted(set(fps)), {}
    for f in fps:
        out[f] = f
    def find(x):
        while out[x] != x:
            x = out[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= threshold:
                out[find(a)] = find(b)
    return {f: find(f) for f in fps}


def check(rows, docs, threshold=3):
    fps = [plain(t) for _, t in docs]
    root = roots(fps, threshold)
    least = {}
    for (i, _), f in zip(docs, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = [(i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(docs, fps)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = QUERIES["op13_simhash_copies"](spark, SF)
    assert out.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    check(out.collect(), docs)


def test_the_code_is_perfect():
    rng = np.random.default_rng(1)
    halves = rng.integers(0, 1 << 32, 2000, np.uint64)
    anchor = S.home(halves)
    assert (np.bitwise_count(anchor ^ halves) <= S.RADIUS).all() and (S.home(anchor) == anchor).all()
    assert (anchor >> np.uint64(31) == halves >> np.uint64(31)).all()
    for bit in range(31):  # code words are 3 bits apart: a neighbour's home is the word itself
        assert (S.home(anchor ^ np.uint64(1 << bit)) == anchor).all()


@pytest.mark.parametrize("threshold", [0, 1])
def test_copies_go_to_all_anchors_in_reach(threshold):
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 64, 50, np.uint64)
    anchor, i, at_home = S.anchors(fps, threshold)
    found = set(zip(anchor.tolist(), i.tolist()))
    assert len(found) == len(anchor) and at_home.sum() == 100
    for n, fp in enumerate(fps.tolist()):
        for half in range(2):
            own = fp >> 32 * half & 0xFFFFFFFF
            for flips in [(a, b) for a in range(32) for b in range(a, 32)]:  # all anchors within two bits
                x = own ^ (1 << flips[0]) ^ ((1 << flips[1]) if flips[0] != flips[1] else 0)
                if int(S.home(np.array([x], np.uint64))[0]) == x and (x ^ own).bit_count() <= S.RADIUS + threshold:
                    assert (x | half << 32, n) in found or (x ^ own) >> 31 == 1 and threshold == 0


def near(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return fp


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize(("threshold", "small", "hot"), [(1, 8, 16_384), (3, 8, 16_384), (4, 8, 16_384), (3, 2, 40), (1, 1, 7), (3, 1, 7)])
def test_links_connect_all_that_is_near(spark, monkeypatch, small, hot, threshold):
    """Chains, a dense cluster, random ones; with small limits anchors are split into cells."""
    monkeypatch.setattr(S, "SMALL", small)
    monkeypatch.setattr(S, "HOT", hot)
    rng = random.Random(threshold)
    fps = [rng.getrandbits(64) for _ in range(150)] + [0]
    for _ in range(20):
        chain = rng.choice(fps)
        for _ in range(6):
            chain = near(rng, chain, threshold)
            fps.append(chain)
    centre = rng.getrandbits(64)
    fps += [near(rng, centre, rng.randint(0, 3)) for _ in range(250)]
    fps += [centre & 0xFFFFFFFF | rng.getrandbits(32) << 32 for _ in range(120)]  # one half in common
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    if hot < 100:
        anchored = frame.mapInArrow(lambda b: S._cover(threshold // 2, b), "anchor long, fp long, home boolean")
        assert anchored.groupBy("anchor").count().filter(f"count > {hot}").count() > 0
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in S.links(frame, threshold).collect()]
    assert all((a ^ b).bit_count() <= threshold for a, b in pairs)
    got = {f: f for f in fps}
    def find(x):
        while got[x] != x:
            x = got[x]
        return x
    for a, b in pairs:
        got[find(a)] = find(b)
    want = roots(fps, threshold)
    assert len({find(f) for f in fps}) == len(set(want.values()))
    assert all(find(f) == find(w) for f, w in want.items())


def test_long_texts_in_parts(monkeypatch):
    text = prose(random.Random(3), 500)
    whole = S.simhash(text.encode())
    monkeypatch.setattr(S, "SHINGLES", 7)
    assert S.simhash(text.encode()) == whole == plain(text)


def test_awkward_rows(spark, awkward, awkward_rows, nothing):
    check(S.near_copies(awkward).collect(), [(r[0], r[1]) for r in awkward_rows])
    assert S.near_copies(nothing).count() == 0


def test_edits_and_hot_groups(spark):
    rng = random.Random(9)
    base = prose(rng, 400).split()
    docs = [(i, " ".join(base)) for i in range(200)]
    for i in range(200, 320):
        edited = list(base)
        edited[rng.randrange(400)] = "changed"
        docs.append((i, " ".join(edited).upper() if i % 2 else "\n".join(edited)))
    docs += [(None, None)] * 5 + [(None, " ".join(base))] * 2 + [(1000 + i, prose(rng, 50)) for i in range(30)]
    check(S.near_copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect(), docs)

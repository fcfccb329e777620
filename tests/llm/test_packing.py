import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from liftspark.llm.bfd import pack, pack_documents
from liftspark.llm.drr import fill, pack_mixture, tail_sizes
from liftspark.llm.tokens import Encoder, default_vocabulary
from tests.llm.conftest import SCHEMA, prose

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def own():
    return Encoder(default_vocabulary())


def test_encoder(own, reference):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "1", "é", "!", " \n", "\n ", " ", "\x1c", "\x85", " ", "<|endoftext|>", "日", "́", "🙂", "Word"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.ids(text), np.uint16).tolist() == reference(text)[:-1], repr(text)


def slow_best_fit(lengths, window):
    """How full windows get when each piece is put into the fullest that has room, longest piece first."""
    out = [window] * sum(n // window for n in lengths)
    rest = []
    for n in sorted((n % window for n in lengths if n % window), reverse=True):
        fits = [r for r in rest if r >= n]
        if fits:
            rest.remove(min(fits))
            rest.append(min(fits) - n)
        else:
            rest.append(window - n)
    return sorted(out + [window - r for r in rest])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=40), st.integers(1, 33))
def test_best_fit_decreasing(lengths, window):
    windows = pack(lengths, window)
    assert sorted(sum(n for _, _, n in w) for w in windows) == slow_best_fit(lengths, window)
    pieces = defaultdict(list)
    for w in windows:
        for doc, start, n in w:
            pieces[doc].append((start, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, k in sorted(pieces[doc]):
            assert start == at and k > 0
            at += k
        assert at == n


def test_awkward_best_fit(awkward, awkward_rows, reference):
    rows = pack_documents(awkward, window=256, buffer_tokens=5000).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    pieces = Counter()
    texts = Counter((i, tuple(reference(t))) for i, t, *_ in awkward_rows)
    whole = defaultdict(list)
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert not ids[r.n_tokens :].any() and not positions[r.n_tokens :].any()
        for a, b, doc, start, n in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts, r.lengths):
            assert b - a == n and positions[a:b].tolist() == list(range(n))
            whole[doc].append((start, ids[a:b].tolist()))
            pieces[doc] += n
    assert pieces == Counter(sum(([i] * len(t) * k for (i, t), k in texts.items()), []))
    for (doc, t), k in texts.items():
        if sum(x[0] == doc for x in texts) == 1 and k == 1:
            assert [x for _, p in sorted(whole[doc]) for x in p] == list(t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), max_size=8), min_size=1, max_size=4), st.integers(1, 40), st.integers(1, 20))
def test_fill_takes_everything_once(lengths, window, serving):
    share = [1 / len(lengths)] * len(lengths)
    left = sum(map(sum, lengths))
    sizes = [window] * (left // window) + tail_sizes(left % window)
    used, at = [0] * len(sizes), {}
    for sequence, offset, s, d, start, n in fill(lengths, [0.0] * len(lengths), share, window, serving):
        assert offset == used[sequence] and n > 0
        used[sequence] += n
        assert at.get((s, d), 0) == start
        at[s, d] = start + n
    assert used == sizes
    assert all(at.get((s, d), 0) == n for s, q in enumerate(lengths) for d, n in enumerate(q))


def test_windows_keep_to_the_targets(spark):
    """With two sources of many documents each, every prefix of a lane's windows has the target shares."""
    lengths = [[100] * 300, [37] * 200]
    share = [0.8, 0.2]
    served = [0, 0]
    for sequence, _, s, _, _, n in fill(lengths, [0.0, 0.0], share, 256, 64):
        served[s] += n
        if sequence < 100 and sequence:
            assert abs(served[0] - 0.8 * sum(served)) <= 256


@pytest.mark.parametrize("lane_tokens, targets", [(4_000_000, None), (3000, None), (3000, {"a": 3, None: 1})])
def test_awkward_mixture(awkward, awkward_rows, reference, lane_tokens, targets):
    rows = pack_mixture(awkward, targets=targets, window=256, lane_tokens=lane_tokens).collect()
    texts = Counter((i, tuple(reference(t))) for i, t, *_ in awkward_rows)
    total = Counter()
    sequences = defaultdict(list)
    whole = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id, r.doc_tokens].append((r.start, ids))
        total[r.doc_id] += r.length
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == 256 or at & (at - 1) == 0 and at < 256
    assert total == Counter(sum(([i] * len(t) * k for (i, t), k in texts.items()), []))
    for (doc, t), k in texts.items():
        if k == 1 and sum(x[0] == doc and len(x[1]) == len(t) for x in texts) == 1:
            assert [x for _, p in sorted(whole[doc, len(t)]) for x in p] == list(t)


def test_empty(nothing):
    assert pack_documents(nothing).count() == 0
    assert pack_mixture(nothing).count() == 0


def test_deficits_carry_over_lanes(spark):
    """A lane begins with the source that is owed most after the lanes before it."""
    rng = random.Random(2)
    rows = [(i, prose(rng, 30 if i % 4 else 90), "en", "ab"[i % 4 == 0], 1) for i in range(400)]
    out = pack_mixture(spark.createDataFrame(rows, SCHEMA), window=128, lane_tokens=5000).collect()
    every, a = sum(r.length for r in out), sum(r.length for r in out if r.source == "a")
    lanes = sorted({r.sequence_id >> 24 for r in out})
    assert len(lanes) > 5
    done = got = checked = 0
    for lane in lanes:
        part = [r for r in out if r.sequence_id >> 24 == lane]
        owed = a / every * done - got
        if abs(owed) > 200 and len({r.source for r in part}) == 2:
            first = min(part, key=lambda r: (r.sequence_id, r.offset))
            assert first.source == ("a" if owed > 0 else "b")
            checked += 1
        done, got = done + sum(r.length for r in part), got + sum(r.length for r in part if r.source == "a")
    assert checked > 3


def test_checksum(spark):
    from pyspark.sql import functions as F

    row = pack_mixture(spark.createDataFrame([(1, "hello world", "en", "a", 1)], SCHEMA)).withColumn("c", F.crc32("ids"))
    for r in row.collect():
        assert r.c == zlib.crc32(r.ids)

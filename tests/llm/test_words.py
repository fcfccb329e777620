import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from liftspark.llm import quality
from liftspark.llm.words import BYTE, BYTE_LOWER, Texts, owners, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab AB\n\t\x1cé日#$|", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(column):
    t = Texts(pa.array(column, pa.string()))
    s, e, first = t.words()
    got = [[t.data[a:b].tobytes().decode() for a, b in zip(s[i:j], e[i:j])] for i, j in zip(first, first[1:])]
    assert got == [WORD.findall(x or "") for x in column]
    h = t.hashes(s, e, BYTE)
    flat = [w for x in got for w in x]
    assert len(set(h.tolist())) == len(set(flat)) and len({(w, int(x)) for w, x in zip(flat, h)}) == len(set(flat))
    low = t.hashes(s, e, BYTE_LOWER)
    fold = [w.translate({c: c + 32 for c in range(65, 91)}) for w in flat]
    assert len({(w, int(x)) for w, x in zip(fold, low)}) == len(set(fold)) == len(set(low.tolist()))


def test_a_slice_and_a_long_word():
    column = pa.array(["x", "aa bb", "c" * 3_000_000 + " d", None])
    t = Texts(column.slice(1))
    s, e, first = t.words()
    assert (e - s).tolist() == [2, 2, 3_000_000, 1] and first.tolist() == [0, 2, 4, 4]
    alone = Texts(pa.array(["c" * 3_000_000]))
    a, b, _ = alone.words()
    assert alone.hashes(a, b)[0] == t.hashes(s, e)[2]


@settings(max_examples=100, deadline=None)
@given(texts)
def test_shingles(column):
    t = Texts(pa.array(column, pa.string()))
    s, e, first = t.words()
    g, at = shingles(t.hashes(s, e), first, 3)
    for x, a, b in zip(column, at, at[1:]):
        w = WORD.findall(x or "")
        want = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
        assert b - a == len(want)


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) for j in range(3) if grams[tuple(words[i : i + 3])] > 1}
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_base_measures(column):
    got = quality.base_measures(Texts(pa.array(column, pa.string())))
    assert [list(map(int, r)) for r in zip(*got)] == [brute(x) for x in column]


@pytest.mark.parametrize("first, want", [([0, 0, 2, 3], [1, 1, 2]), ([0], [])])
def test_owners(first, want):
    import numpy as np

    assert owners(np.array(first)).tolist() == want

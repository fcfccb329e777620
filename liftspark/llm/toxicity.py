"""Toxicity by noisy-channel deobfuscation.

Words that look disguised (digits or signs for letters, letters spaced out, letters repeated) become character
lattices: each character stands for one or more letters, a separator may or may not end a word, a repeated letter may
count once or twice. The likeliest reading under a character language model, found by Viterbi search, replaces
them. Restored texts are scored by how toxic the labelled texts are that hold the same words or word beginnings.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import chunks
from liftspark.llm.words import BYTE_LOWER, Texts, mix, owners

#: Labelled rows that the classifier is fitted on at most (those of the least hashes of their ids).
FIT_ROWS = 30_000
#: Toxic texts that must hold a word or beginning for it to count; texts that the prior is worth.
#: Texts in which a word stands between the same words, as in copies, count once, as do those with one word of a beginning.
MIN_TOXIC, PRIOR_TEXTS = 3, 5.0
#: Bytes of the word beginnings that count besides whole words.
BEGINNINGS = (4, 5, 6)
#: Less telling words don't add up.
STRONG = 0.55
#: Characters of a string that are read at once, and those that the next piece of a longer string repeats.
PIECE, OVERLAP = 400, 48
THRESHOLD = 0.7

#: Letters that digits and signs stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou",
}
#: Log chances: of a stand-in for one of its letters, of a sign that means itself, of a separator inside a word.
STAND_IN, ITSELF, JOINED = math.log(0.3), math.log(0.02), math.log(0.7)
SPLIT = math.log(0.3)
#: Log chance that a sign at an end of a word is punctuation.
ENDS, PUNCTUATION = "!|*", math.log(0.5)

SYMBOLS = 28  # 0 a word's edge, 1 to 26 letters, 27 any other letter
ORDER = 4
_code = np.zeros(256, np.int64)
_code[65:91] = _code[97:123] = np.arange(1, 27)
_code[128:] = 27
_LETTER = (_code > 0).astype(np.uint8)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_DIGIT, _FRONT, _INNER, _STAND_IN = (np.isin(np.arange(256), list(s)) for s in (b"0123456789", b"@$", b"!|+", "".join(LEET).encode()))
_SEPARATOR = np.isin(np.arange(256), list(b" .-_*/"))


def _count_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    for batch in chunks(batches):
        texts = Texts(batch.column("text"))
        s, e, _ = texts.runs(_LETTER)
        if not len(s):
            continue
        # words one after the other, three edges in between
        length = e - s
        at = np.cumsum(length + 3) - length
        line = np.zeros(int(at[-1] + length[-1]) + 3, np.int64)
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        line[np.repeat(at, length) + inside] = _code[texts.data[np.repeat(s, length) + inside]]
        gram = ((line[:-3] * SYMBOLS + line[1:-2]) * SYMBOLS + line[2:-1]) * SYMBOLS + line[3:]
        last = line[3:] > 0
        last |= line[2:-1] > 0  # a letter, or the edge right after one
        total += np.bincount(gram[last], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def language_model(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities of a symbol after three others, from all texts; orders interpolate by the evidence they have."""
    rows = documents.select(F.col(text).alias("text")).mapInArrow(_count_symbols, "gram long, n long")
    count = np.zeros(SYMBOLS**ORDER)
    for gram, n in rows.groupBy("gram").agg(F.sum("n")).collect():  # SYMBOLS**ORDER rows at most
        count[gram] = n
    count = count.reshape((SYMBOLS,) * ORDER)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        n = count.sum(axis=tuple(range(ORDER - order)))
        kinds = (n > 0).sum(axis=-1, keepdims=True)
        p = (n + np.maximum(kinds, 1) * p) / (n.sum(axis=-1, keepdims=True) + np.maximum(kinds, 1))
    return np.log(p).astype(np.float32)


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def lattice(word: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """For each step the strings it may stand for, with log chances."""
    steps: list[list[tuple[str, float]]] = []
    front, back = len(word) - len(word.lstrip(ENDS)), len(word.rstrip(ENDS))
    i = 0
    while i < len(word):
        c = word[i]
        j = i
        while j < len(word) and word[j] == c:
            j += 1
        if spaced and _SEPARATOR[min(ord(c), 255)]:
            steps.append([("", JOINED), (" ", SPLIT)])
        elif c in LEET:
            end = [("", PUNCTUATION)] if not spaced and (i < front or i >= back) else []
            steps.extend([[*((x, STAND_IN) for x in LEET[c]), (c, ITSELF), *end]] * (j - i))
        elif c.isalpha() and j - i > 2:
            steps.append([(c, math.log(0.6)), (c * 2, math.log(0.35)), (c * (j - i), math.log(0.05))])
        else:
            steps.extend([[(c, 0.0)]] * (j - i))
        i = j
    return steps


def decode(word: str, model: np.ndarray, spaced: bool = False) -> str:
    """The likeliest reading of a lower-case word."""
    best: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
    for step in [*lattice(word, spaced), [("", 0.0)]]:
        after: dict[tuple[int, int, int], tuple[float, str]] = {}
        for state, (score, text) in best.items():
            for out, chance in step:
                s, at = score + chance, state
                for c in out:
                    if c == " ":
                        s, at = s + model[at][0], (0, 0, 0)
                    else:
                        x = _symbol(c)
                        s, at = s + model[at][x], (at[1], at[2], x)
                known = after.get(at)
                if known is None or (s, text + out) > known:
                    after[at] = (s, text + out)
        best = after
    return max((score + model[state][0], text) for state, (score, text) in best.items())[1]


def disguised(texts: Texts) -> tuple[list[str], list[bool], np.ndarray]:
    """Strings that may hide words, whether their letters are spaced out, and the text of each."""
    data, n = texts.data, len(texts.data)
    if not n:
        return [], [], np.zeros(0, np.int64)
    letter = _code[data] > 0
    edge = np.zeros(n + 1, bool)
    edge[texts.start] = True

    def before(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n, bool)
        out[1:] = mask[:-1]
        return out & ~edge[:n]

    def after(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n, bool)
        out[:-1] = mask[1:]
        return out & ~edge[1:]

    small = _lower[data]
    same = np.zeros(n, bool)
    same[1:] = small[1:] == small[:-1]
    same &= ~edge[:n] & letter & (data < 128)
    triple = same & before(same)
    s, e, first = texts.words()
    doc = owners(first)
    hit = np.unique(np.searchsorted(s, np.flatnonzero(_STAND_IN[data] | triple), "right") - 1)
    letters = np.append(0, np.cumsum(letter))
    out, spaced, where = [], [], []
    for i in hit[letters[e[hit]] > letters[s[hit]]].tolist():
        out.append(data[s[i] : e[i]].tobytes().decode())
        spaced.append(False)
        where.append(int(doc[i]))
    # single letters (or stand-ins) with single separators between; signs that may end a word only between separators
    mark = (letter & (data < 128)) | _DIGIT[data] | _FRONT[data]
    filled = ~_SEPARATOR[data]
    alone = np.flatnonzero((mark & ~before(mark) & ~after(mark)) | (_INNER[data] & ~before(filled) & ~after(filled)))
    if len(alone):
        joined = np.zeros(len(alone), bool)
        joined[1:] = (alone[1:] - alone[:-1] == 2) & _SEPARATOR[data[alone[1:] - 1]]
        joined &= ~(edge[alone] | edge[alone - 1])  # not over the border of two texts
        a = np.flatnonzero(~joined)
        b = np.append(a[1:], len(alone))
        for i, j in zip(a[b - a > 2].tolist(), b[b - a > 2].tolist()):
            piece = data[alone[i] : alone[j - 1] + 1]
            if (_code[piece] > 0).any():
                out.append(piece.tobytes().decode("utf-8", "replace"))
                spaced.append(True)
                where.append(int(np.searchsorted(texts.start, alone[i], "right") - 1))
    return out, spaced, np.array(where, np.int64)


#: More than three of one letter in a row.
DRAWN = re.compile(r"([^\W\d_])\1{3,}")


class Restorer:
    """Restores disguised strings and keeps what it has read."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.read: dict[tuple[str, bool], str] = {}

    def __call__(self, word: str, spaced: bool) -> str:
        word = word.lower().strip(".,;:?\"'()[]{}<>#%&-_=~/\\")
        key = word, spaced
        if key not in self.read:
            if len(self.read) > 200_000:
                self.read.clear()
            # long strings are read in pieces that overlap, so that time stays linear and a word lies whole in one of them
            if len(word) > PIECE:
                word = DRAWN.sub(r"\1\1\1", word)
            self.read[key] = " ".join(decode(word[i : i + PIECE], self.model, spaced) for i in range(0, max(1, len(word) - OVERLAP), PIECE - OVERLAP))
        return self.read[key]


def _runs(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and word beginnings (lower case, letters only), the text of each, and what varies with independent use.

    That is the words next to a word, and the words that have a beginning.
    """
    s, e, first = texts.runs(_LETTER)
    doc, h = owners(first), texts.hashes(s, e, BYTE_LOWER)
    near = mix(np.append(np.uint64(0), h[:-1]) ^ (np.append(h[1:], np.uint64(0)) * np.uint64(3))) if len(h) else h
    hashes, docs, nears = [h], [doc], [near]
    for n in BEGINNINGS:
        longer = e - s > n
        hashes.append(mix(texts.hashes(s[longer], s[longer] + n, BYTE_LOWER) ^ np.uint64(n)))
        docs.append(doc[longer])
        nears.append(h[longer])
    return np.concatenate(hashes), np.concatenate(docs), np.concatenate(nears)


def word_features(texts: Texts, restore: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the restored texts: of all words, and of what disguised strings were restored to; see ``_runs``."""
    h, doc, near = _runs(texts)
    words, spaced, where = disguised(texts)
    if words:
        restored = Texts(pa.array([restore(w, x) for w, x in zip(words, spaced)], pa.large_string()))
        more, at, beside = _runs(restored)
        whole = np.arange(len(more)) < len(restored.runs(_LETTER)[0])  # then beginnings follow
        size = mix((texts.end - texts.start)[where[at]].astype(np.uint64))  # copies have one size
        h, doc, near = np.concatenate([h, more]), np.concatenate([doc, where[at]]), np.concatenate([near, np.where(whole, size, beside)])
    return h, doc, near


def _distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def held_out(id: str) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3 (no id: the empty text)."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _toxic_counts(model: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and the words next to them, with how many texts have the feature there first."""
    restore = Restorer(model)
    for batch in chunks(batches):
        h, doc, near = word_features(Texts(batch.column("text")), restore)
        order = np.lexsort((near, h, doc))
        h, doc, near = h[order], doc[order], near[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        new = first.copy()
        new[1:] |= near[1:] != near[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[new].view(np.int64)), pa.array(near[new].view(np.int64)), pa.array(first[new].astype(np.int64))], names=["feature", "near", "n"]
        )


def _clean_counts(model: np.ndarray, wanted: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    restore = Restorer(model)
    for batch in chunks(batches):
        h, _ = _distinct(*word_features(Texts(batch.column("text")), restore)[:2])
        h, n = np.unique(h[np.isin(h, wanted)], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["feature", "n"])


def fit(documents: DataFrame, labels: DataFrame, model: np.ndarray, id: str = "doc_id", text: str = "text", toxic: str = "toxic", fit_rows: int = FIT_ROWS):
    """Features (sorted) and the chance of each that a text which holds it is toxic.

    Learns from labelled rows that are not held out, ``fit_rows`` at most.
    """
    known = (
        labels.filter(F.col(toxic).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id))
        .groupBy(F.col(id).alias("k")).agg(F.max(toxic).alias("toxic"))
        .orderBy(F.xxhash64("k"), "k").limit(fit_rows)
    )
    chosen = documents.select(F.col(id).alias("k"), F.col(text).alias("text")).join(F.broadcast(known), "k")

    in_toxic = (
        chosen.filter("toxic = 1").select("text")
        .mapInArrow(lambda b: _toxic_counts(model, b), "feature long, near long, n long")
        .groupBy("feature", "near").agg(F.sum("n").alias("n"))
        .groupBy("feature").agg(F.least(F.count("*"), F.sum("n")).alias("n"))
        .filter(F.col("n") >= MIN_TOXIC)
    )
    # both results are bounded by the words of the rows that the fit may use
    of_toxic = np.array(in_toxic.collect(), np.int64).reshape(-1, 2)
    of_toxic = of_toxic[np.argsort(of_toxic[:, 0].view(np.uint64))]
    feature, n_toxic = of_toxic[:, 0].copy().view(np.uint64), of_toxic[:, 1].astype(float)
    n_clean = np.zeros(len(feature))
    in_clean = chosen.filter("toxic = 0").select("text").mapInArrow(lambda b: _clean_counts(model, feature, b), "feature long, n long")
    for f, n in in_clean.groupBy("feature").agg(F.sum("n")).collect():
        n_clean[np.searchsorted(feature, np.int64(f).view(np.uint64))] = n
    totals = dict(known.groupBy("toxic").count().collect())
    prior = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    return feature, (n_toxic + PRIOR_TEXTS * prior) / (n_toxic + n_clean + PRIOR_TEXTS)


def toxicity(
    documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``documents``.

    The score is the chance that at least one of the text's telling words is meant as toxic; below ``STRONG`` it is half the
    chance of the most telling one. Null and empty texts, and all texts if no label is usable, score 0. Labels that are null,
    not 0 or 1, or of held-out ids are not used; of several labels of an id the largest counts. Rows of a repeated or
    null id are scored one by one. Other columns are not read; an empty table gives an empty result.
    """
    model = language_model(documents, text)
    feature, chance = fit(documents, labels, model, id, text, toxic, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in chunks(batches):
            texts = Texts(batch.column("text"))
            score = np.zeros(texts.n)
            if len(feature):
                h, doc, _ = word_features(texts, restore)
                at = np.minimum(np.searchsorted(feature, h), len(feature) - 1)
                found = feature[at] == h
                which, doc = _distinct(at[found].astype(np.uint64), doc[found])
                p = chance[which.astype(np.int64)]
                strong = p >= STRONG
                np.maximum.at(score, doc, p / 2)
                clear = np.bincount(doc[strong], np.log1p(-np.minimum(p[strong], 1 - 1e-12)), texts.n)
                score = np.where(clear < 0, -np.expm1(clear), np.minimum(score, STRONG))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    rows = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

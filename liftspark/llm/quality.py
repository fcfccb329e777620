"""Quality rules: log-likelihood ratio of hashed n-grams between trusted and raw text.

Two multinomials over hashed one- and two-grams are counted on whole texts: one on the
trusted documents, one on all. A document's score is the mean log ratio of its n-grams;
junk, whose n-grams the raw text has and the trusted text lacks, comes out low.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import checked_broadcast, chunks, stored
from liftspark.llm.words import BYTE_LOWER, Texts, grams, mix, owners, within

BUCKETS = 1 << 16
#: Added to each count of both multinomials.
SMOOTH = 1.0
#: The share of trusted documents that the threshold may reject at most.
TRUSTED_LOSS = 0.002
#: Resolution of the threshold.
STEP = 0.001

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

#: Space 0, letters, digits and all beyond ASCII 1, punctuation 2.
KIND = np.full(256, 2, np.uint8)
KIND[0:33] = 0
KIND[48:58] = KIND[65:91] = KIND[97:123] = KIND[128:] = 1

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the one- and two-grams of all texts, and the text of each."""
    s, e, first = texts.runs(KIND)
    h, doc = texts.hashes(s, e, BYTE_LOWER), owners(first)
    pair = within(doc, 2)
    bucket = np.concatenate([h, grams(h, 2)[pair]]) & np.uint64(BUCKETS - 1)
    return bucket.astype(np.int64), np.concatenate([doc, doc[: len(pair)][pair]])


def base_measures(texts: Texts) -> list[np.ndarray]:
    """For each text: words, their characters, symbols, repeated lines, words in repeated windows of three."""
    s, e, first = texts.words()
    h, doc, n = texts.hashes(s, e), owners(first), texts.n

    def inside(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(at, texts.end) - np.searchsorted(at, texts.start)

    chars = np.bincount(doc, e - s, n).astype(np.int64) - inside(np.flatnonzero((texts.data & 0xC0) == 0x80))
    marks = np.zeros(256, bool)
    marks[list(SYMBOLS)] = True

    line = np.ones(256, np.uint8)
    line[10] = 0
    a, b, at = texts.runs(line)
    worded = np.searchsorted(s, b) > np.searchsorted(s, a)
    lines = np.stack([owners(at)[worded].astype(np.uint64), texts.hashes(a, b)[worded]])
    order = np.lexsort(lines[::-1])
    same = np.all(lines[:, order][:, 1:] == lines[:, order][:, :-1], axis=0)
    dup = np.bincount(lines[0, order][1:][same].astype(np.int64), minlength=n)

    keep = within(doc, 3)
    g, d = grams(h, 3), doc[: len(keep)]
    g = g ^ mix(d.astype(np.uint64) + np.uint64(1))
    at = np.flatnonzero(keep)
    order = at[np.argsort(g[at], kind="stable")]
    twin = g[order][1:] == g[order][:-1]
    hit = np.zeros(len(g), bool)
    hit[order[1:][twin]] = hit[order[:-1][twin]] = True
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[j : j + len(hit)] |= hit
    return [np.diff(first), chars, inside(np.flatnonzero(marks[texts.data])), dup, np.bincount(doc[covered], minlength=n)]


def mean_ratio(texts: Texts, ratio: np.ndarray) -> np.ndarray:
    """The mean log ratio of each text's n-grams, 0 for a text without words."""
    bucket, doc = features(texts)
    return np.bincount(doc, ratio[bucket], texts.n) / np.maximum(np.bincount(doc, minlength=texts.n), 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in chunks(batches):
        bucket, doc = features(Texts(batch.column("text")))
        trusted = np.asarray(batch.column("trusted").fill_null(False).to_numpy(zero_copy_only=False), bool)
        raw += np.bincount(bucket, minlength=BUCKETS)
        good += np.bincount(bucket[trusted[doc]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(good[at])], names=["bucket", "raw", "good"])


def fit(documents: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log ratio for each of the ``BUCKETS`` hashed n-grams, from all of ``documents``.

    ``trusted`` holds ids of trusted documents (a null id matches none). Without any trusted text all ratios are 0.
    """
    ids = trusted.select(F.col(id).cast("long").alias("k")).na.drop().distinct().withColumn("trusted", F.lit(True))
    rows = documents.select(F.col(id).cast("long").alias("k"), F.col(text).alias("text")).join(checked_broadcast(ids), "k", "left")
    counts = (
        rows.select("text", "trusted")
        .mapInArrow(_count, "bucket long, raw long, good long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
        .collect()  # one row a bucket: BUCKETS rows at most
    )
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, r, g in counts:
        raw[bucket], good[bucket] = r, g
    if not good.sum():
        return np.zeros(BUCKETS)
    return np.log((good + SMOOTH) / (good.sum() + SMOOTH * BUCKETS)) - np.log((raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS))


def score(documents: DataFrame, ratio: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, the base measures and ``llr``, the mean log ratio (0 for a text without words), one row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = Texts(batch.column("text"))
            arrays = [batch.column("id"), *(pa.array(x.astype(np.int64)) for x in base_measures(texts)), pa.array(mean_ratio(texts, ratio))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", *(c.split()[0] for c in BASE.split(", ")), "llr"])

    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id long, {BASE}, llr double").withColumnRenamed("id", id)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def threshold(scored: DataFrame, labelled: DataFrame, id: str = "doc_id") -> float:
    """The multiple of ``STEP`` that parts trusted from other labelled documents best.

    ``labelled`` has ``id`` and boolean ``good``. Among thresholds that reject at most ``TRUSTED_LOSS``
    of the trusted documents which pass the base rules, the one with most others rejected and fewest lost;
    it lies midway between the scores it parts. Minus infinity (rejects none) without labelled documents of both kinds.
    """
    marks = labelled.select(F.col(id).cast("long").alias(id), "good").na.drop().distinct()
    joined = scored.filter(~base_failed()).select(id, F.floor(F.col("llr") / STEP).alias("cell")).join(checked_broadcast(marks), id)
    # cells: scores are mean log ratios, so their range is bounded by the log of the corpus size
    cells = sorted((c, g, n) for c, g, n in joined.groupBy("cell", "good").count().collect())
    good, bad = sum(n for _, g, n in cells if g), sum(n for _, g, n in cells if not g)
    if not good or not bad:
        return -math.inf
    best, at, lost, caught = 0, -math.inf, 0, 0
    steps = sorted({c for c, _, _ in cells})
    by_cell = {(c, g): n for c, g, n in cells}
    for c, after in zip(steps, [*steps[1:], steps[-1] + 1]):
        lost += by_cell.get((c, True), 0)
        caught += by_cell.get((c, False), 0)
        if lost <= TRUSTED_LOSS * good and caught > best:
            best, at = caught, (c + 1 + after) / 2 * STEP
    return at


def quality_filter(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """The rows of ``documents`` that ``quality_verdicts`` keeps, with all their columns.

    The last pass judges rows where they lie, so nothing is joined, and rows of a null or repeated id are judged one by one.
    """
    marks = labels.select(id, (F.col(quality) == 1).alias("good"))
    ratio = fit(documents, marks.filter("good"), id, text)
    known = documents.select(id, text).join(checked_broadcast(marks.na.drop().select(id).distinct()), id, "left_semi")
    at = threshold(stored(score(known, ratio, id, text), "quality-labelled"), marks, id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            texts = Texts(batch.column(text))
            words, _, _, _, repeated = base_measures(texts)
            kept = (words >= MIN_WORDS) & (100 * repeated <= MAX_REPEAT_PERCENT * words) & (mean_ratio(texts, ratio) >= at)
            yield batch.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)


def quality_verdicts(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """One row for each row of ``documents``: ``id``, base measures, ``base_failed``, ``llr``, ``threshold``, ``kept``.

    ``labels`` gives 1 to trusted and 0 to rejected documents; documents without a label, and labels that
    are null or of unknown documents, take no part in the target or the threshold. Repeated ids are scored
    row by row. A null or empty text has no words and fails the base rules. Other columns play no part, so
    their names may clash. An empty table gives an empty result.
    """
    marks = labels.select(id, (F.col(quality) == 1).alias("good"))
    ratio = fit(documents, marks.filter("good"), id, text)
    scored = stored(score(documents, ratio, id, text), "quality")
    at = threshold(scored, marks, id)
    return scored.select(
        "*", base_failed().alias("base_failed"), F.lit(at).alias("threshold"), (~base_failed() & (F.col("llr") >= at)).alias("kept")
    )

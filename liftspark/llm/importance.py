"""Importance resampling towards a target distribution over hashed n-grams.

All texts of a batch are joined with a separator between them. One pass of a regular expression over the joined bytes finds
every word; a search of the words' places among the ends of the documents tells whose they are, and masks n-grams that
would reach from one document into the next. What is left is counted by bucket. A document's weight is the sum of the log
ratios, target against raw, of its features; the draw adds Gumbel noise from a hash of the id, which samples without
replacement in proportion to the weights, the same rows in every run.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import chunks, stored
from liftspark.operators.prefix import cumulative_at, ordered_prefix

BUCKETS, ORDER = 10_000, 1
#: Log ratios and noise are whole multiples of one part in ``SCALE``.
SCALE = 1000
MIN_WORDS, PERCENT, SEED = 20, 10, 2024
#: A byte that is part of no word.
SENTINEL = b"\x00"
#: What ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` leaves of lower-cased UTF-8: digits, letters, and all bytes of what is beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words that are handled at once.
BLOCK = 1 << 17


def joined(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts of a column in lower case (A-Z only) with a sentinel after each, and where each ends."""
    texts = [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    return SENTINEL.join([*texts, b""]).lower(), ends


def runs(data: bytes, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each word starts, and for each length up to ``order`` the CRC-32 of the words of that run, joined by spaces, that ends at each word."""
    starts: list[np.ndarray] = []
    out: list[list[np.ndarray]] = [[] for _ in range(order)]
    last = [0] * order  # of the run of each length that ends before this block
    words = WORD.finditer(data)
    while block := list(islice(words, BLOCK)):
        starts.append(np.fromiter((m.start() for m in block), np.int64, len(block)))
        tokens = [m[0] for m in block]
        ending = list(map(crc32, tokens))
        out[0].append(np.array(ending, np.int64))
        for k in range(1, order):
            before = [last[k - 1], *ending[:-1]]
            last[k - 1] = ending[-1]
            ending = [crc32(t, crc32(b" ", c)) for t, c in zip(tokens, before)]
            out[k].append(np.array(ending, np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), [np.concatenate([none, *o]) for o in out]


def features(column: pa.Array, order: int = ORDER, buckets: int = BUCKETS) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for each length of runs: (bucket of each run, its text). No run crosses two texts."""
    data, ends = joined(column)
    starts, hashed = runs(data, order)
    owner = np.searchsorted(ends, starts, "right")
    out = [(hashed[0] % buckets, owner)]
    for k in range(1, order):
        inside = owner[k:] == owner[:-k]
        out.append((hashed[k][k:][inside] % buckets, owner[k:][inside]))
    return np.bincount(owner, minlength=len(ends)), out


def counts(texts: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chunks(batches):
            for bucket, _ in features(batch.column("text"), order, buckets)[1]:
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.collect():  # one row a bucket
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log ratio of each bucket, one added to every count, rounded down to parts in ``SCALE``."""
    s, t, b = int(raw.sum()), int(target.sum()), len(raw)
    return np.array([math.floor(SCALE * math.log((y + 1) * (s + b) / ((x + 1) * (t + b)))) for x, y in zip(raw.tolist(), target.tolist())], np.int64)


def weights(documents: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """``doc_id, n_words, n_features, weight``, one row for each row of ``documents``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            n = batch.num_rows
            words, found = features(batch.column("text"), order, len(gain))
            number, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for bucket, owner in found:  # owners ascend
                total = np.append(0, np.cumsum(gain[bucket]))
                first = np.searchsorted(owner, np.arange(n + 1))
                number += np.diff(first)
                weight += np.diff(total[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(number), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(id: str, seed: int = SEED) -> Column:
    """Gumbel noise from 32 bits of a hash of seed and id (a null id counts as empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    documents: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    order: int = ORDER,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for each row of ``documents``.

    Features are all runs of 1 to ``order`` words, repeats counted. Of the documents with ``min_words`` words at least,
    ``percent`` of a hundred (rounded down) are drawn: those of the highest ``score``, ties to the smaller id and null ids
    last; ``rank`` numbers them from 1, others have null. A null or empty text has no feature and weight 0. Rows of one id
    are documents of their own with the same noise; equal rows get different ranks. An empty target makes rare features
    weigh more; an empty table of documents gives an empty result. Other columns are not read.
    """
    gain = gains(counts(documents, text, order, buckets), counts(target, target_text, order, buckets))
    scored = weights(documents, gain, id, text, order).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = stored(scored.withColumn("last_id", F.coalesce("doc_id", F.lit((1 << 63) - 1))), "importance")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    eligible = scored.filter(F.col("n_words") >= min_words)
    draws = eligible.count() * percent // 100
    if not draws:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    # the score at the cut first: only rows that reach it are shuffled
    least = cumulative_at(eligible, "score", "last_id", f"array({draws})").first()["value"]
    reaches = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(int(least)))
    ranked = ordered_prefix(scored.filter(reaches), "score", "last_id", rank_col="rank")
    place = F.when(F.col("rank") < draws, F.col("rank") + 1).cast("long")
    return ranked.select(*columns, place.alias("rank")).union(scored.filter(~reaches).select(*columns, F.lit(None).cast("long")))


SQL = r"""
WITH crc_table AS (
    SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS steps
    FROM range(256) r(i)),
texts AS (
    SELECT 'raw' AS side, doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'target', NULL, NULL, coalesce(text, '') FROM benchmark),
found AS (
    SELECT side, row, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
per_text AS (
    SELECT side, row, w, count(*) AS n FROM (SELECT side, row, unnest(words) AS w FROM found) GROUP BY ALL),
bytes AS (
    SELECT w, list_transform(range(length(hex(w)) // 2), lambda i: ('0x' || substr(hex(w), 2 * i + 1, 2))::BIGINT) AS b
    FROM (SELECT DISTINCT w FROM per_text)),
bucketed AS (
    SELECT w, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, steps[1 + xor(c & 255, x)])), 4294967295) % 10000 AS bucket
    FROM bytes, crc_table),
counted AS (
    SELECT bucket, sum(n) FILTER (side = 'raw') AS s, sum(n) FILTER (side = 'target') AS t FROM per_text JOIN bucketed USING (w) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (sum(s) OVER () + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1) * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM counted),
weighed AS (
    SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM per_text JOIN bucketed USING (w) JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY row),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM found LEFT JOIN weighed USING (row) WHERE side = 'raw'),
placed AS (
    SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS eligible FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= eligible * 10 // 100 THEN place END AS rank FROM placed
"""

"""SimHash near duplicates by anchor-point covering.

A fingerprint of 64 bits is cut into two halves; of two fingerprints that differ in few bits, one half differs in half as
many at most. The anchors of a half are a covering code: the perfect Hamming code on 31 bits beside one free bit, so that
every half lies within ``RADIUS`` of exactly one anchor, its home. A fingerprint is copied to every anchor within that radius
plus the threshold of a half. Then whatever is near a fingerprint meets it at its home, and only there it is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from liftspark.llm.common import checked_broadcast, chunks, stored
from liftspark.llm.graph import components

WORDS, SEED, THRESHOLD = 3, 42, 3
#: Bits of a half, of them the Hamming code's; every half is that near to its anchor.
HALF, CODED, RADIUS = 32, 31, 1
#: Fingerprints that are copied to their anchors at once, and shingles whose bits are counted at once.
BLOCK, SHINGLES = 4096, 1 << 15
#: Rows of an anchor up to which all are compared by shifting the rows, and beyond which the anchor is split.
SMALL, HOT = 8, 16_384


def simhash(raw: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of one text: a bit is set if it is in over half of the hashes of its shingles, repeats counted."""
    tokens = raw.lower().split()  # of bytes: A-Z, and white space of ASCII
    if not tokens:
        return 0
    text, width = b" ".join(tokens), min(words, len(tokens))
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = ends - sizes, ends[width - 1 :]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(ends), SHINGLES):
        spans = zip(starts[at : at + SHINGLES].tolist(), ends[at : at + SHINGLES].tolist())
        hashes = np.array([xxh64_intdigest(text[a:b], seed) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, fp``, the fingerprint as a signed long, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [simhash(t or b"", words, seed) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


#: Of the positions 1 to 31 those whose number has bit ``j``; their parities name the bit to turn.
_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, CODED + 1) if p >> j & 1)) for j in range(CODED.bit_length())]
_ONE = np.uint64(1)


def home(halves: np.ndarray) -> np.ndarray:
    """The anchor within ``RADIUS`` of each half: its code word, and the free bit as it is."""
    place = np.zeros(halves.shape, np.uint64)
    for j, mask in enumerate(_CHECKS):
        place |= (np.bitwise_count(halves & mask).astype(np.uint64) & _ONE) << np.uint64(j)
    turned = _ONE << np.where(place > 0, place - _ONE, np.uint64(0))
    return np.where(place > 0, halves ^ turned, halves)


@lru_cache
def near_masks(threshold: int) -> np.ndarray:
    """All changes of ``threshold`` bits of a half at most; no change comes first."""
    return np.array([sum(1 << b for b in bits) for n in range(threshold + 1) for bits in combinations(range(HALF), n)], np.uint64)


def anchors(fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each half, the anchors within ``RADIUS + threshold`` of it: (anchor, index of the fingerprint, whether it is its home).

    As the code is perfect these are the homes of all halves within ``threshold``. Anchors of the second half have bit 32 set.
    """
    masks, out = near_masks(threshold), []
    for half in range(2):
        own = (fps >> np.uint64(HALF * half)) & np.uint64((1 << HALF) - 1)
        found = home(own[:, None] ^ masks[None, :])
        first = found[:, :1].copy()
        found.sort(axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        i, j = np.nonzero(new)
        out.append((found[i, j] | np.uint64(half << HALF), i, found[i, j] == first[i, 0]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _cover(threshold: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            fps = batch.slice(at, BLOCK).column("fp").to_numpy(zero_copy_only=False)
            anchor, i, at_home = anchors(fps.view(np.uint64), threshold)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fps[i]), pa.array(at_home)], names=["anchor", "fp", "home"])


def _small(first: np.ndarray, size: np.ndarray, fp: np.ndarray, at_home: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside groups of a few rows: each row with the next, the one after it, and so on."""
    i = np.repeat(first, size) + within_groups(size)
    rest = np.repeat(size, size) - within_groups(size)  # rows of the group from this one on
    for shift in range(1, int(size.max(initial=0))):
        i, rest = i[rest > shift], rest[rest > shift]
        j = i + shift
        meet = np.where(fp[i] < fp[j], at_home[i], at_home[j])  # at the home of the lesser
        near = meet & (np.bitwise_count(fp[i] ^ fp[j]) <= threshold) & (fp[i] != fp[j])
        yield fp[i[near]], fp[j[near]]


def within_groups(size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _large(fp: np.ndarray, at_home: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected inside one group: one less than rows at most."""
    label = np.arange(len(fp))
    for h in np.flatnonzero(at_home):
        near = np.flatnonzero(np.bitwise_count(fp ^ fp[h]) <= threshold)
        labels, where = np.unique(label[near], return_index=True)
        if len(labels) > 1:
            other = labels != label[h]
            yield fp[near[where[other]]], np.full(int(other.sum()), fp[h])
            label[np.isin(label, labels)] = labels[0]


def _compare(threshold: int, split: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by ``anchor``; with ``split``, rows of an anchor of over ``HOT`` rows come out as they are instead."""
    names = ["a", "b", "anchor", "home"]

    def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())], names=names)

    def passed(anchor: np.ndarray, fp: np.ndarray, at_home: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64()), pa.array(anchor), pa.array(at_home)], names=names)

    def groups(anchor: np.ndarray, fp: np.ndarray, at_home: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(anchor)))
        some = (size > 1) & (size <= SMALL)
        for a, b in _small(first[some], size[some], fp, at_home, threshold):
            yield links(a, b)
        for at, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
            own = slice(at, at + n)
            found = list(_large(fp[own], at_home[own], threshold))
            if found:
                yield links(*(np.concatenate(x) for x in zip(*found)))

    held = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
    hot: int | None = None
    for batch in batches:
        rows = (
            batch.column("anchor").to_numpy(zero_copy_only=False),
            batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64),
            batch.column("home").to_numpy(zero_copy_only=False).astype(bool),
        )
        held = tuple(np.concatenate(x) for x in zip(held, rows))
        if hot is not None:
            n = int(np.searchsorted(held[0], hot, "right"))
            yield passed(*(x[:n] for x in held))
            held = tuple(x[n:] for x in held)
            if len(held[0]):
                hot = None
        if not len(held[0]):
            continue
        n = int(np.searchsorted(held[0], held[0][-1]))  # the last group may go on
        yield from groups(*(x[:n] for x in held))
        held = tuple(x[n:] for x in held)
        if split and len(held[0]) > HOT:
            hot = int(held[0][0])
            yield passed(*held)
            held = tuple(x[:0] for x in held)
    yield from groups(*held)


def links(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``a, b``: links that connect the fingerprints ``fp`` (distinct) which differ in ``threshold`` bits at most.

    Not all pairs: inside an anchor of many rows only as many as connect them. Rows of a hot anchor are compared block with block.
    """
    shape = "a long, b long, anchor long, home boolean"
    copies = fps.select("fp").mapInArrow(lambda b: _cover(threshold // 2, b), "anchor long, fp long, home boolean")
    met = copies.repartition("anchor").sortWithinPartitions("anchor")
    found = stored(met.mapInArrow(lambda b: _compare(threshold, True, b), shape), "anchored")
    hot = found.filter("anchor is not null").select("anchor", F.col("a").alias("fp"), "home")
    sizes = stored(hot.groupBy("anchor").agg(F.ceil(F.count("*") / HOT).alias("parts"), F.ceil(F.count_if("home") / HOT).alias("homes")), "hot-anchors")
    dealt = hot.join(checked_broadcast(sizes), "anchor").withColumn("at", F.xxhash64("fp"))

    def spread(rows: DataFrame, at_home: bool, part: F.Column, home: F.Column) -> DataFrame:
        # two cells of one hash merge: more is compared, nothing is lost
        return rows.select(F.xxhash64("anchor", part, home).alias("anchor"), "fp", F.lit(at_home).alias("home"))

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("each") - 1))
    part, place = F.pmod("at", F.col("parts")), F.pmod("at", F.col("homes"))
    cells = spread(dealt.filter("home").withColumn("each", F.col("parts")).withColumn("c", every), True, F.col("c"), place).union(
        spread(dealt.filter("homes > 0").withColumn("each", F.col("homes")).withColumn("c", every), False, part, F.col("c"))
    )
    more = cells.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(lambda b: _compare(threshold, False, b), shape)
    return found.filter("anchor is null").select("a", "b").union(more.select("a", "b"))


def near_copies(
    documents: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: int = THRESHOLD, seed: int = SEED
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``documents``.

    Words are lower-cased (A-Z only); shingles are ``words`` neighbouring words, or all of a shorter text. Fingerprints that
    differ in ``threshold`` bits at most are linked; ``component_id`` is the least id that links reach, the document's own
    included. A null text, or one without a word, has fingerprint zero and is linked like any other. Rows of a null id are
    linked too, but name no component; one of such rows only has a null ``component_id``. Repeated ids and rows count row by
    row. Other columns are not read; an empty table gives an empty result.
    """
    marked = stored(fingerprints(documents, id, text, words, seed), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(nodes, threshold)).select(F.col("node").alias("fp"), "root")
    labelled = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of = labelled.join(named, "root").select(F.col("fp").alias("of"), "component_id")
    return marked.join(of, F.col("fp") == F.col("of"), "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

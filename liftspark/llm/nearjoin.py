"""Near-duplicate join on word shingles by a MinHash LSH forest, with exact verification.

Documents with equal shingle sets are one node. Each tree of the forest orders nodes by a string of MinHash values;
nodes that share a prefix hang from one trie node. All with a common prefix are linked to the least of them, so a
bucket of any size gives as many links as members, and the components of these links hold every candidate pair. Inside
a component, Jaccard similarities are exact: counted block against block, never written out as pairs. Prefixes are
shortened until the recall, estimated from the similarities found, reaches the target; where nothing is found, until a pair
at the threshold would be found with that probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import checked_broadcast, chunks, stored
from liftspark.llm.graph import components
from liftspark.llm.words import BYTE, Texts, mix, shingles

WORDS = 5
THRESHOLD = "0.8"
VALUES, TREES, DEPTH = 128, 112, 8
TARGET_RECALL = 0.9999
#: Prefixes of a part, on average; a task holds a few times as many.
PART_ROWS = 500_000
#: Nodes and shingles of a block, on average.
BLOCK_NODES, BLOCK_SHINGLES = 512, 400_000

_MULTIPLY = mix(np.arange(1000, 1000 + VALUES, dtype=np.uint64)) | np.uint64(1)


@lru_cache
def tree_values(trees: int = TREES) -> np.ndarray:
    """The order in which each tree looks at the values: a fixed random permutation each."""
    return np.array([np.random.default_rng(7 + t).permutation(VALUES) for t in range(trees)])


@lru_cache
def detection(similarity: float, depth: int, trees: int = TREES) -> float:
    """The chance that two sets of this similarity share a prefix of ``depth`` in some tree."""
    s = min(1.0, max(0.0, similarity))
    return sum(
        comb(VALUES, m) * s**m * (1 - s) ** (VALUES - m) * (1 - (1 - comb(m, depth) / comb(VALUES, depth)) ** trees) for m in range(VALUES + 1)
    )


@lru_cache
def per_found(depth: int) -> np.ndarray:
    """For each thousandth of similarity, how many such pairs there are for one that is found."""
    return np.array([1 / max(detection(c / 1000, depth), 1e-9) for c in range(1001)])


def set_keys(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set: equal sets have equal keys; 0 for an empty one."""
    with np.errstate(over="ignore"):
        total = np.append(np.uint64(0), np.cumsum(mix(sets ^ np.uint64(0xA5A5)), dtype=np.uint64))
        key = mix((total[first[1:]] - total[first[:-1]]) ^ np.diff(first).astype(np.uint64))
    return np.where(np.diff(first) > 0, key, np.uint64(0)).view(np.int64)


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``VALUES`` MinHash values of 32 bits of each non-empty set."""
    out = np.empty((len(first) - 1, VALUES), np.uint32)
    with np.errstate(over="ignore"):
        for j, by in enumerate(_MULTIPLY):
            out[:, j] = np.minimum.reduceat(sets * by, first[:-1]) >> np.uint64(32)
    return out


def _sign(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        texts = Texts(batch.column("text"))
        s, e, first = texts.words()
        sets, at = shingles(texts.hashes(s, e, BYTE), first, words)
        held = np.diff(at) > 0
        rows = iter(signatures(sets, np.append(at[:-1][held], len(sets)))) if held.any() else iter(())
        sig = [next(rows).tobytes() if h else None for h in held.tolist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(set_keys(sets, at)), pa.array(np.diff(at)), pa.array(sig, pa.binary())],
            names=["doc_id", "key", "n", "sig"],
        )


def _prefixes(depth: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes of all trees with their nodes, packed by part of the range of hashes."""
    order = tree_values()[:, :depth]
    seeds = mix(np.arange(1, TREES + 1, dtype=np.uint64))
    for batch in batches:
        for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
            keys, first = np.unique(part.column("key").to_numpy(zero_copy_only=False), return_index=True)
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(part.num_rows, VALUES)[first]
            prefix = np.broadcast_to(seeds, (len(sig), TREES)).copy()
            for level in range(depth):
                prefix = mix(prefix ^ sig[:, order[:, level]])
            prefix = prefix.ravel()
            at = np.argsort(prefix)
            rows = np.stack([prefix[at].view(np.int64), keys[at // TREES]], 1)
            where = (prefix[at] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            cut = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            data = [rows[i:j].tobytes() for i, j in zip(cut, np.append(cut[1:], len(rows)))]
            yield pa.RecordBatch.from_arrays([pa.array(where[cut].astype(np.int64)), pa.array(data, pa.binary())], names=["part", "rows"])


def bucket_links(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From rows of prefix and node: the least node of each prefix, and a link to it from each other one."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.append(True, rows[1:, 0] != rows[:-1, 0])
    heads = rows[new]
    links = np.stack([rows[:, 1], heads[np.cumsum(new) - 1, 1]], 1)
    return heads, links[links[:, 0] != links[:, 1]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the nodes in each prefix, from rows sorted by part; of rows seen only the least node of each prefix is kept."""
    now: int | None = None
    held: list[np.ndarray] = []
    n = most = 0

    def settled() -> pa.RecordBatch:
        nonlocal held, n, most
        heads, links = bucket_links(np.concatenate(held))
        held, n, most = [heads], len(heads), max(2 * len(heads), 2 * PART_ROWS)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["key", "head"])

    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("rows")):
            if part != now:
                if now is not None:
                    yield settled()
                now, held, n, most = part, [], 0, 2 * PART_ROWS
            held.append(np.frombuffer(data.as_py(), np.int64).reshape(-1, 2))
            n += len(held[-1])
            if n > most:
                yield settled()
    if now is not None:
        yield settled()


def candidate_links(signed: DataFrame, depth: int) -> DataFrame:
    """Links that connect the nodes of each bucket, over the buckets of all trees: as many as its members, mostly to the least of them.

    ``signed`` has ``key, sig`` of each node at least once. Prefixes are shuffled once, as packed arrays.
    """
    parts = max(1, -(-signed.count() * TREES // PART_ROWS))
    rows = signed.select("key", "sig").mapInArrow(lambda b: _prefixes(depth, parts, b), "part long, rows binary")
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_links, "key long, head long").distinct()


def _shared(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of the intersections of the first ``left`` sets with all sets."""
    m = len(sets)
    who = np.repeat(np.arange(m), [len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    # shingles that the same sets hold count together; those of one set don't count
    held = np.bincount(column, minlength=len(values))
    tag = np.zeros(len(values), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(tag, column, mix(np.arange(1, m + 1, dtype=np.uint64))[who])
    _, lead, pattern, weight = np.unique(np.where(held > 1, tag, np.uint64(0)), return_index=True, return_inverse=True, return_counts=True)
    kept = held[lead] > 1
    number = np.cumsum(kept) - 1
    chosen = np.zeros(len(values), bool)
    chosen[lead[kept]] = True
    inside = chosen[column]
    who, column = who[inside], number[pattern[column[inside]]]
    weight = weight[kept].astype(np.float32)
    out = np.zeros((left, m), np.float32)
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    for lo in range(0, len(weight), 4096):
        hi = min(len(weight), lo + 4096)
        a, b = np.searchsorted(column, (lo, hi))
        grid = np.zeros((m, hi - lo), np.float32)
        grid[who[a:b], column[a:b] - lo] = 1
        out += (grid[:left] * weight[lo:hi]) @ grid.T
    return np.rint(out).astype(np.int64)


def _verify(threshold: Fraction, depth: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group: tuple | None = None
    rows: dict[int, tuple[int, bool, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        _, a, b, blocks = group
        keys = sorted(rows, key=lambda k: not rows[k][1])  # the nodes of block a first
        left = sum(rows[k][1] for k in keys)
        sets = [rows[k][2] for k in keys]
        size, copies = np.array([len(s) for s in sets]), np.array([rows[k][0] for k in keys])
        if left == 0 or len(keys) < 2:
            return
        shared = _shared(sets, left)
        union = size[:left, None] + size[None, :] - shared
        link = shared * threshold.denominator >= union * threshold.numerator
        if a == b:
            np.fill_diagonal(link, False)
        else:
            link[:, :left] = False
        cell = np.rint(shared[link] / union[link] * 1000).astype(int)
        weight = np.zeros(link.shape)
        weight[link] = per_found(depth)[cell]
        twice = 1 if a == b else 0  # within a block each link shows from both ends
        texts, docs, expected = link.sum(1), (link * copies).sum(1), weight.sum(1)
        if not twice:
            texts = np.append(texts, link[:, left:].sum(0))
            docs = np.append(docs, (link[:, left:] * copies[:left, None]).sum(0))
            expected = np.append(expected, weight[:, left:].sum(0))
        root = list(range(len(keys)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(*(x.tolist() for x in np.nonzero(link))):
            i, j = find(i), find(j)
            if i != j:
                root[max(i, j)] = min(i, j)
        ids = np.array(keys, np.int64)
        roots = ids[[find(i) for i in range(len(keys))]]
        at = np.flatnonzero(texts > 0)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x[at]) for x in (ids, roots, texts.astype(np.int64), docs.astype(np.int64), expected)), pa.array([blocks == 1] * len(at), pa.bool_())],
            names=["key", "root", "text_links", "doc_links", "expected", "whole"],
        )

    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            columns = [part.column(c).to_pylist() for c in ("comp", "a", "b", "blocks", "block", "key", "copies", "shingles")]
            for comp, a, b, blocks, block, key, copies, data in zip(*columns):
                if group != (comp, a, b, blocks):
                    if group:
                        yield from flush()
                    group = (comp, a, b, blocks)
                    rows.clear()
                rows[key] = (copies, block == a, np.frombuffer(data, np.uint64))
    if group:
        yield from flush()


def _sets(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        texts = Texts(batch.column("text"))
        s, e, first = texts.words()
        sets, at = shingles(texts.hashes(s, e, BYTE), first, words)
        ok = set_keys(sets, at) == batch.column("key").to_numpy(zero_copy_only=False)  # an id may name several texts
        pick = pa.array(np.flatnonzero(ok))
        data = [sets[at[i] : at[i + 1]].tobytes() for i in pick.to_pylist()]
        kept = batch.select(["key", "comp", "copies", "blocks"]).take(pick)
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(data, pa.binary())], names=["key", "comp", "copies", "blocks", "shingles"])


def verified(rows: DataFrame, nodes: DataFrame, links: DataFrame, words: int, threshold: Fraction, depth: int) -> DataFrame:
    """Exact links of each node with the nodes of its component, by blocks: ``key, root, text_links, doc_links, expected, whole``.

    ``root`` is a node that it is connected with inside the blocks, the same for all so connected; ``whole`` says that they were the whole component.
    """
    comp = components(links).select(F.col("node").alias("key"), F.col("root").alias("comp"))
    members = stored(nodes.join(comp, "key"), "members")
    sizes = members.groupBy("comp").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    wanted = members.join(sizes, "comp").select(F.col("rep").alias("doc_id"), "key", "comp", "copies", "blocks")
    sets = rows.join(checked_broadcast(stored(wanted, "wanted")), "doc_id").mapInArrow(
        lambda b: _sets(words, b), "key long, comp long, copies long, blocks long, shingles binary"
    )
    block = F.pmod(F.xxhash64("key"), F.col("blocks"))
    pairs = (
        sets.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("a", F.least("block", "other"))
        .withColumn("b", F.greatest("block", "other"))
        .drop("other")
    )
    found = (
        pairs.repartition("comp", "a", "b")
        .sortWithinPartitions("comp", "a", "b")
        .mapInArrow(lambda b: _verify(threshold, depth, b), "key long, root long, text_links long, doc_links long, expected double, whole boolean")
    )
    return stored(found, "verified")


def near_duplicates(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: str = THRESHOLD,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links`` for each row of ``documents``.

    Two documents are linked if the Jaccard similarity of their sets of shingles of ``words`` words is at least
    ``threshold`` (given as text, so that it is exact); a text of fewer words has all its words as its one shingle.
    ``n_links`` counts the other documents linked, copies included, ``n_text_links`` the other shingle sets.
    ``class_id`` is the least id of all documents connected by links. A text that is null or has no word is linked to none
    and is its own class. Rows of a null id are linked to none and have a null class. Rows of one id and one set are
    copies of each other; one id may name several texts, each linked on its own. Equal sets are told by 64-bit keys.
    Other columns are not read; an empty table gives an empty result.
    """
    limit = Fraction(threshold)
    rows = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(rows.mapInArrow(lambda b: _sign(words, b), "doc_id long, key long, n long, sig binary"), "signed")
    present = signed.filter("doc_id is not null and n > 0")
    nodes = stored(present.groupBy("key").agg(F.first("n").alias("n"), F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "nodes")
    depth = DEPTH
    while True:
        found = verified(rows, nodes, candidate_links(present, depth), words, limit, depth)
        links, expected = found.agg(F.sum("text_links"), F.sum("expected")).first()
        if depth == 1 or (links >= target_recall * expected if links else detection(float(limit), depth) >= target_recall):
            break
        depth -= 1

    linked = found.groupBy("key").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    parts = components(found.filter("not whole").select("key", "root")).withColumnRenamed("node", "key")
    roots = found.filter("whole").select("key", "root").union(parts)
    labelled = nodes.select("key", "rep", "copies").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    classes = labelled.groupBy("root").agg(F.min("rep").alias("class_id"))
    verdicts = (
        labelled.join(classes, "root").join(linked, "key", "left")
        .select("key", "class_id", (F.col("copies") - 1 + F.coalesce("doc_links", F.lit(0))).alias("n_links"), F.coalesce("text_links", F.lit(0)).alias("n_text_links"))
    )
    alone = F.col("sig").isNull() | F.col("doc_id").isNull()
    return (
        signed.withColumn("at", F.when(~alone, F.col("key")))
        .select("doc_id", "at")
        .join(verdicts, F.col("at") == F.col("key"), "left")
        .select(
            "doc_id",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
        )
    )

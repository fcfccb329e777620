"""Mixture-controlled packing: deficit round-robin over source queues.

Documents are dealt by hash into lanes of bounded size. A lane keeps one queue per source and fills windows from
them: a source earns its target share of every token packed, the source with the largest credit serves next, and
what it owes or is owed goes on to the next window. Since a lane drains its queues, what each source is owed at a
lane's start follows from token sums of the lanes before it, so lanes run in parallel and deficits still carry over.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftspark.llm.common import stored
from liftspark.llm.tokens import default_vocabulary, encoder, token_rows

#: Tokens of a lane, on average; a task holds one lane's ids at a time.
LANE_TOKENS = 4_000_000
#: A source serves at least this much at once, if its document and the window allow.
SERVING = 512
_SEQUENCE_BITS = 24

SCHEMA = "sequence_id long, offset long, doc_id long, source string, start long, length long, doc_tokens long, ids binary"


def tail_sizes(n: int) -> list[int]:
    """Powers of two that sum to ``n``, largest first: sequences that need no padding."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def fill(lengths: list[list[int]], owed: list[float], share: list[float], window: int, serving: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(sequence, offset, source, document, start, length) of every piece of a lane.

    ``lengths`` has the documents of each source's queue in order, ``owed`` the tokens that each source is
    owed at first, ``share`` the part of all tokens that it is to have.
    """
    left = sum(map(sum, lengths))
    sizes = [window] * (left // window) + tail_sizes(left % window)
    credit = np.array(owed, float)
    gain = np.array(share, float)
    at, start = [0] * len(lengths), [0] * len(lengths)
    credit[[i for i, q in enumerate(lengths) if not q]] = -np.inf
    for sequence, size in enumerate(sizes):
        room = size
        credit += gain * size
        while room:
            s = int(np.argmax(credit))
            rest = lengths[s][at[s]] - start[s]
            n = min(rest, room, max(serving, int(credit[s])))
            if n == 0:  # a document without tokens
                at[s] += 1
            else:
                yield sequence, size - room, s, at[s], start[s], n
                room -= n
                credit[s] -= n
                start[s] += n
                if n == rest:
                    at[s], start[s] = at[s] + 1, 0
            if at[s] == len(lengths[s]):
                credit[s] = -np.inf


def pack_mixture(
    documents: DataFrame,
    targets: Mapping[str | None, float] | None = None,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    vocabulary: str | None = None,
    window: int = 2048,
    end_id: int = 1,
    lane_tokens: int = LANE_TOKENS,
    serving: int = SERVING,
) -> DataFrame:
    """One row per piece: ``sequence_id, offset, doc_id, source, start, length, doc_tokens, ids``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. Sequences have ``window`` tokens; what a
    lane has left at its end goes to sequences of a power of two of tokens, so nothing is padded. ``targets`` weighs
    sources (others get 0 and fill up once the weighed ones run out); by default sources keep the shares that they have of all
    tokens. Every document, a null or empty text too, ends with ``end_id`` and every row is packed whole, also
    if its id is null or repeated. A null source is a source of its own. An empty table gives no rows.
    """
    path = vocabulary or default_vocabulary()
    tokens = stored(token_rows(documents, id, text, source, path, end_id).withColumn("turn", F.xxhash64("doc_id", "n", F.crc32("ids"))), "tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    lanes = max(1, -(-total // lane_tokens))
    tokens = tokens.withColumn("lane", F.pmod("turn", F.lit(lanes)))

    # what each source is owed when its lane begins: its share of all tokens before, less its own before
    held = tokens.groupBy("lane", "source").agg(F.sum("n").alias("own"))
    before = Window.unboundedPreceding, -1
    lane_start = (
        held.groupBy("lane").agg(F.sum("own").alias("all"))
        .select(F.col("lane").alias("l"), F.coalesce(F.sum("all").over(Window.orderBy("lane").rowsBetween(*before)), F.lit(0)).alias("all_before"))
    )
    if targets is None:
        weight = F.sum("own").over(Window.partitionBy("source")) / F.lit(float(max(total, 1)))
    else:
        whole = float(sum(targets.values()))
        weight = F.lit(0.0)
        for name, w in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name).cast("string")), w / whole).otherwise(weight)
    own_before = F.coalesce(F.sum("own").over(Window.partitionBy("source").orderBy("lane").rowsBetween(*before)), F.lit(0))
    debts = (
        held.withColumn("share", weight).withColumn("own_before", own_before).join(lane_start, F.col("lane") == F.col("l"))
        .select("lane", "source", "share", (F.col("share") * F.col("all_before") - F.col("own_before")).alias("owed"))
    )
    nothing = {"doc_id": "long", "n": "long", "ids": "binary", "turn": "long"}
    heads = debts.select("lane", F.lit(0).alias("kind"), "source", "share", "owed", *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()))
    rows = tokens.select("lane", F.lit(1).alias("kind"), "source", *(F.lit(None).cast("double").alias(c) for c in ("share", "owed")), *nothing)
    dealt = heads.unionByName(rows).repartition(lanes, "lane").sortWithinPartitions("lane", "kind", F.asc_nulls_last("source"), "turn", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(path).kind
        lane: int | None = None
        sources: dict[str | None, int] = {}
        share: list[float] = []
        owed: list[float] = []
        docs: list[list[tuple[int | None, bytes]]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            width = np.dtype(kind).itemsize
            queues = [[len(x) // width for _, x in q] for q in docs]
            names = list(sources)
            out: list[tuple] = []
            for sequence, offset, s, d, start, n in fill(queues, owed, share, window, serving):
                doc, ids = docs[s][d]
                piece = np.frombuffer(ids, kind, n, start * width).astype("<u4").tobytes()
                out.append(((lane << _SEQUENCE_BITS) + sequence, offset, doc, names[s], start, n, queues[s][d], piece))
                if len(out) == 4096:
                    yield batch_of(out)
                    out.clear()
            if out:
                yield batch_of(out)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lane", "kind", "source", "share", "owed", "doc_id", "ids")]
            for to, is_doc, name, part, debt, doc, ids in zip(*columns):
                if to != lane:
                    if lane is not None:
                        yield from flush()
                    lane = to
                    for x in (sources, share, owed, docs):
                        x.clear()
                if is_doc:
                    docs[sources[name]].append((doc, ids))
                else:
                    sources[name] = len(sources)
                    share.append(part)
                    owed.append(debt)
                    docs.append([])
        if lane is not None:
            yield from flush()

    return dealt.mapInArrow(run, SCHEMA)


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)

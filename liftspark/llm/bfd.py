"""Best-fit-decreasing packing of token ids into fixed windows.

Each task tokenises its documents and packs them in bounded buffers, so nothing is shuffled. Documents longer
than a window are split without loss: full windows first, the rest goes with the other pieces. Pieces are placed
longest first into the open window with the least sufficient room, which a segment tree over room sizes finds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from liftspark.llm.tokens import default_vocabulary, encoder, token_rows

#: Tokens that a task packs together.
BUFFER_TOKENS = 2_000_000


class Rooms:
    """Open windows by the room they have left; finds the least room that suffices."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        i = room + self.leaves
        while i and not self.tree[i]:
            self.tree[i] = True
            i //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """A window with the least room of at least ``need``: (room, window)."""
        i = need + self.leaves
        while not self.tree[i]:
            while i % 2:  # a right child has no later sibling
                i //= 2
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i *= 2
            if not self.tree[i]:
                i += 1
        room = i - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            while i:
                self.tree[i] = i < self.leaves and (self.tree[2 * i] or self.tree[2 * i + 1])
                if self.tree[i]:
                    break
                i //= 2
        return room, window


def pack(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start in it, length)."""
    out: list[list[tuple[int, int, int]]] = []
    rest: list[tuple[int, int, int]] = []
    for doc, n in enumerate(lengths):
        full = n // window * window
        out.extend([(doc, start, window)] for start in range(0, full, window))
        if n > full:
            rest.append((doc, full, n - full))
    rooms = Rooms(window)
    for doc, start, n in sorted(rest, key=lambda p: (-p[2], p[0])):
        found = rooms.take(n)
        room, at = found if found else (window, len(out))
        if not found:
            out.append([])
        out[at].append((doc, start, n))
        if room > n:
            rooms.put(room - n, at)
    return out


SCHEMA = (
    "sequence_id long, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, starts array<long>, lengths array<int>"
)


def pack_documents(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    window: int = 2048,
    end_id: int = 1,
    pad_id: int = 0,
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """One row per packed window: a row of the id matrix, its segments and where they come from.

    ``ids`` and ``position_ids`` hold ``window`` little-endian unsigned numbers each (2 bytes if the vocabulary
    allows, else 4): ids padded with ``pad_id``, and positions that restart at 0 with every segment (0 in the padding).
    Segment ``i`` spans ``cu_seqlens[i]`` to ``cu_seqlens[i+1]`` and holds ``lengths[i]`` ids of document
    ``doc_ids[i]`` from ``starts[i]`` on. Every document ends with ``end_id``; a null or empty text is that id
    alone. Each row of the input is packed by itself, also if its id is null or repeated; an empty table gives
    no windows. Other columns are not read. ``sequence_id`` numbers windows by task, with gaps between tasks.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(path).kind
        base, done = TaskContext.get().partitionId() << 32, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, total
            windows = pack([len(x) for x in held], window)
            for first in range(0, len(windows), 512):
                part = windows[first : first + 512]
                ids = np.full((len(part), window), pad_id, np.dtype(kind).newbyteorder("<"))
                positions = np.zeros_like(ids)
                for row, pieces in enumerate(part):
                    at = 0
                    for doc, start, n in pieces:
                        ids[row, at : at + n] = held[doc][start : start + n]
                        positions[row, at : at + n] = np.arange(n)
                        at += n
                ends = [np.cumsum([0, *(n for _, _, n in p)]).tolist() for p in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(base + done + first, base + done + first + len(part)), pa.int64()),
                        pa.array([e[-1] for e in ends], pa.int32()),
                        pa.array([r.tobytes() for r in ids], pa.binary()),
                        pa.array([r.tobytes() for r in positions], pa.binary()),
                        pa.array(ends, pa.list_(pa.int32())),
                        pa.array([[docs[d] for d, _, _ in p] for p in part], pa.list_(pa.int64())),
                        pa.array([[s for _, s, _ in p] for p in part], pa.list_(pa.int64())),
                        pa.array([[n for _, _, n in p] for p in part], pa.list_(pa.int32())),
                    ],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )
            done += len(windows)
            docs.clear()
            held.clear()
            total = 0

        for batch in batches:
            for doc, n, ids in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("ids")):
                if total and total + n > buffer_tokens:
                    yield from flush()
                docs.append(doc)
                held.append(np.frombuffer(ids.as_buffer(), kind).copy())
                total += n
        yield from flush()

    return token_rows(documents, id, text, None, path, end_id).select("doc_id", "n", "ids").mapInArrow(run, SCHEMA)

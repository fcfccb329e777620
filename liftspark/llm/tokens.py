"""Token ids of whole texts under a public byte-level BPE vocabulary.

The vocabulary file is a parameter. Texts are cut before spaces at which the vocabulary's splitting pattern
always starts a new piece; pieces repeat, so their ids are kept in a bounded table per worker.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import chunks

#: Pieces a worker remembers, and the longest of them in characters.
REMEMBERED, LONGEST = 400_000, 40
#: A space with white space, or the end, on both sides: the pattern may run on over it.
RUN = re.compile(r"\s (\s|$)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a text, as bytes of little-endian unsigned numbers of ``width`` bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        import tokenizers

        byte_of = _byte_of()
        vocabulary = tokenizers.Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if all(c in byte_of for c in token)}
        ranks.pop(b"<|endoftext|>", None)
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.width = 2 if max(ranks.values()) < 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.first, self.later = _Pieces(self, ""), _Pieces(self, " ")

    def direct(self, text: str) -> bytes:
        return array(self.kind, self.encode(text)).tobytes()

    def ids(self, text: str) -> bytes:
        if RUN.search(text):
            return self.direct(text)
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.later.__getitem__, rest))


class _Pieces(dict):
    def __init__(self, encoder: Encoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, piece: str) -> bytes:
        out = self.encoder.direct(self.lead + piece)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = out
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_rows(documents: DataFrame, id: str, text: str, source: str | None, vocabulary: str, end_id: int) -> DataFrame:
    """``doc_id, source, n, ids`` for each row: the text's ids (null: none), then ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = array(enc.kind, [end_id]).tobytes()
        for batch in chunks(batches):
            ids = [enc.ids(t or "") + end for t in batch.column("text").to_pylist()]
            n = pa.array([len(x) // enc.width for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), n, pa.array(ids, pa.binary())], names=["doc_id", "source", "n", "ids"]
            )

    where = F.col(source).cast("string") if source else F.lit(None).cast("string")
    rows = documents.select(F.col(id).cast("long").alias("doc_id"), where.alias("source"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, n long, ids binary")

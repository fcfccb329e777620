"""Language-model scores from an Elias-Fano trie of word pairs that is spread over tasks.

Counts of pairs (a word and the one after it) live in tries: one level of contexts, one of successors that are coded
relative to their context, monotone pointers between them, quantised log counts as values. Neither the tries nor the
vocabulary fit one machine for a large corpus, so both are dealt to shards by hash, and the texts' pairs and words go
to the shards instead, as packed arrays per batch of documents. The model is built so that its log probability falls apart into
terms of single shards:

    p(w | v) = (1 - g) c(vw) / c(v)   if the pair occurs in training,   g p(w)   if not
    p(w)     = (1 - u) c(w) / N       if the word occurs,               u        if not (one class for all unknown words)

with ``g`` and ``u`` the Good-Turing shares of pairs and words seen once, ``(n1 + 1) / (N + 2)``. For a given context these sum
to at most 1: what ``p(w)`` holds for successors already seen stays unused. A text begins in the context of the text's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftspark.llm.common import chunks, stored
from liftspark.llm.eliasfano import EliasFano, joined, parted
from liftspark.llm.words import BYTE_LOWER, Texts, mix, owners

U64 = np.uint64
#: Bytes of text whose words are sent out together, and whose pairs or words a shard holds on average.
BATCH_BYTES, PAIR_SHARD_BYTES, WORD_SHARD_BYTES = 6_000_000, 12_000_000, 48_000_000
#: Bits of a context and of a successor in a pair's key; bits of a word's key.
HALF, WORD_BITS = 28, 56
#: Steps of the quantised log10 of a count, per unit.
STEPS = 4096
END = np.array([mix(np.array([0xE0D], U64))[0] >> U64(64 - WORD_BITS)], U64)

PAIRS, WORDS, META, PART, STATS, VOCABULARY, ASK = range(7)
BLOB = "kind int, shard long, batch long, data binary"


def _codes(counts: np.ndarray) -> np.ndarray:
    """Quantised log10 of counts; 0 for none."""
    return np.rint(np.log10(np.maximum(counts, 1)) * STEPS)


class Trie:
    """Pair counts: contexts, pointers, successors, quantised log10 counts, over a buffer made by ``build``."""

    def __init__(self, buffer: bytes | memoryview):
        contexts, pointers, successors, codes = parted(buffer)
        self.contexts, self.pointers, self.successors = EliasFano(contexts), EliasFano(pointers), EliasFano(successors)
        self.codes = np.frombuffer(codes, np.uint16)

    @staticmethod
    def build(keys: np.ndarray, counts: np.ndarray) -> bytes:
        """``keys``: distinct sorted pair keys."""
        context = keys >> U64(HALF)
        new = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(keys) else np.zeros(0, np.int64)
        rank = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(keys))))
        successor = (rank.astype(U64) << U64(HALF)) | (keys & U64((1 << HALF) - 1))
        codes = _codes(counts).astype(np.uint16)
        pointers = np.append(new, len(keys)).astype(U64)
        return joined([EliasFano.encode(context[new]), EliasFano.encode(pointers), EliasFano.encode(successor), codes.tobytes()])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The code of each pair, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not self.contexts.n:
            return out
        context = keys >> U64(HALF)
        rank = self.contexts.successor(context)
        at = np.flatnonzero(rank < self.contexts.n)
        at = at[self.contexts.get(rank[at]) == context[at]]
        rank = rank[at]
        wanted = (rank.astype(U64) << U64(HALF)) | (keys[at] & U64((1 << HALF) - 1))
        place = self.successors.successor(wanted)
        inside = place < self.pointers.get(rank + 1).astype(np.int64)  # still a successor of this context
        at, place, wanted = at[inside], place[inside], wanted[inside]
        hit = self.successors.get(place) == wanted
        out[at[hit]] = self.codes[place[hit]]
        return out


def _pack_docs(doc: np.ndarray) -> bytes:
    """Document numbers of a batch: 12 bits each if they fit, else 16."""
    if len(doc) and doc.max() >= 1 << 12:
        return b"\2" + doc.astype("<u2").tobytes()
    high = (doc >> 8).astype(np.uint8)
    high = np.append(high, np.zeros(len(high) % 2, np.uint8))
    return b"\1" + (doc & 0xFF).astype(np.uint8).tobytes() + (high[0::2] | high[1::2] << 4).tobytes()


def _unpack_docs(data: memoryview, n: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if raw[0] == 2:
        return np.frombuffer(data, "<u2", n, 1).astype(np.int32)
    pairs = raw[1 + n :]
    high = np.empty(2 * len(pairs), np.uint8)
    high[0::2], high[1::2] = pairs & 15, pairs >> 4
    return raw[1 : 1 + n].astype(np.int32) | high[:n].astype(np.int32) << 8


def _slices(shard: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """The columns of each shard; shards ascend."""
    cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(shard)]):
        yield int(shard[a]), *(c[a:b] for c in columns)


def _spread(keys: np.ndarray) -> np.ndarray:
    """Pair keys with successors in front: those are hashes of the whole pair, so ranges of them are even. Its own inverse."""
    return (keys & U64((1 << HALF) - 1)) << U64(HALF) | keys >> U64(HALF)


def _range(x: np.ndarray, shards: int) -> np.ndarray:
    """The shard, a range of 56-bit numbers, that each belongs to."""
    return ((x >> U64(WORD_BITS - HALF)) * U64(shards) >> U64(HALF)).astype(np.int64)


def _from_least(values: np.ndarray) -> list[bytes]:
    """Sorted numbers of one range, coded from the least of them on."""
    return [values[:1].tobytes(), EliasFano.encode(values - values[0])]


def _values(least: memoryview, coded: memoryview) -> np.ndarray:
    return EliasFano(coded).values() + np.frombuffer(least, U64)


def _blobs(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds, shards, batches, data = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(shards, pa.int64()), pa.array(batches, pa.int64()), pa.array(data, pa.binary())],
        names=["kind", "shard", "batch", "data"],
    )


def _send(pair_shards: int, word_shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, count = TaskContext.get().partitionId() << 32, 0
    parts = (part.slice(i, 1 << 16) for part in chunks(batches, limit=BATCH_BYTES) for i in range(0, max(1, part.num_rows), 1 << 16))
    for part in parts:
        if not part.num_rows:
            continue
        texts = Texts(part.column("text"))
        s, e, first = texts.words()
        train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
        # every text's words, then an end
        n, doc = len(s) + texts.n, owners(first)
        word = np.empty(n, U64)
        ends = first[1:] + np.arange(texts.n)
        inside = np.ones(n, bool)
        inside[ends] = False
        word[ends] = END[0]
        word[inside] = texts.hashes(s, e, BYTE_LOWER) >> U64(64 - WORD_BITS)
        owner = np.empty(n, np.int64)
        owner[ends] = np.arange(texts.n)
        owner[inside] = doc
        context = np.empty(n, U64)
        context[1:] = word[:-1]
        context[first[:-1] + np.arange(texts.n)] = END[0]
        with np.errstate(over="ignore"):
            half = mix(context * U64(0x9E3779B97F4A7C15) + word) >> U64(64 - HALF)
        key = ((context >> U64(WORD_BITS - HALF)) << U64(HALF)) | half
        batch, count, rows = base + count, count + 1, []
        rows.append((META, int(batch % pair_shards), batch, pa_bytes(part, np.bincount(owner, minlength=texts.n), train)))
        key = _spread(key)
        order = np.argsort(key, kind="stable")
        key, w, v, d = key[order], word[order], context[order], owner[order]
        for shard, k, w, v, d in _slices(_range(key, pair_shards), key, w, v, d):
            out = ~train[d]  # of other texts, what to ask the words' shards for
            asks = [np.ascontiguousarray(x[out].view(np.uint8).reshape(-1, 8)[:, :7]).tobytes() for x in (v, w)]
            rows.append((PAIRS, shard, batch, joined([*_from_least(k), _pack_docs(d), np.packbits(~out).tobytes(), *asks])))
        order = np.argsort(word, kind="stable")
        w, d = word[order], owner[order]
        for shard, w, d in _slices(_range(w, word_shards), w, d):
            new = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            pointers = EliasFano.encode(np.append(new, len(w)).astype(U64))
            rows.append((WORDS, shard, batch, joined([*_from_least(w[new]), pointers, _pack_docs(d), np.packbits(train).tobytes()])))
        for i in range(0, len(rows), 64):
            yield _blobs(rows[i : i + 64])


def pa_bytes(part: pa.RecordBatch, n_tokens: np.ndarray, train: np.ndarray) -> bytes:
    ids = part.column("doc_id")
    known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), bool)
    return joined([
        ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), n_tokens.astype(np.int64).tobytes(),
        np.packbits(known).tobytes(), np.packbits(train).tobytes(),
    ])


#: What shards return for a document: quantised log counts of its pairs, pairs not seen in training, log10(c + 0.1) of its words,
#: words known, quantised logs of the counts of contexts of seen pairs and of backed-off words, backed-off words that are known.
CODES, UNSEEN, BASE, KNOWN, CONTEXT, BACKED, BACKED_KNOWN = range(7)
COLUMNS = 7


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Numbers in the least width that holds them, and which that is."""
    if not np.issubdtype(values.dtype, np.integer):
        return 4, values.astype(np.float64).tobytes()
    width = next(i for i, t in enumerate(_WIDTHS) if not len(values) or values.max() <= np.iinfo(t).max)
    return width, values.astype(_WIDTHS[width]).tobytes()


_WIDTHS = (np.uint8, np.uint16, np.uint32, np.int64)
_READ = (*_WIDTHS, np.float64)


def _sums(columns: dict[int, np.ndarray]) -> bytes:
    """For each column the documents that have something, as steps from one to the next, and what. Numbers of 0 and more."""
    head, parts = [], []
    for name, values in columns.items():
        some = np.flatnonzero(values)
        step, steps = _narrow(np.diff(some, prepend=0))
        kind, held = _narrow(values[some])
        head += [name, step, kind]
        parts += [steps, held]
    return joined([bytes(head), *parts])


def _add_sums(data: bytes, to: np.ndarray) -> None:
    head, *parts = parted(data)
    head = bytes(head)
    for i in range(0, len(head), 3):
        name, step, kind = head[i : i + 3]
        steps, held = parts[2 * i // 3 : 2 * i // 3 + 2]
        to[name, np.cumsum(np.frombuffer(steps, _READ[step]), dtype=np.int64)] += np.frombuffer(held, _READ[kind])


def _pack_counts(counts: np.ndarray) -> list[bytes]:
    """Mostly small numbers in a byte each; the places of others and their values."""
    large = np.flatnonzero(counts > 255)
    return [np.minimum(counts, 255).astype(np.uint8).tobytes(), large.astype(np.int64).tobytes(), counts[large].astype(np.int64).tobytes()]


def _unpack_counts(small: memoryview, large: memoryview, values: memoryview) -> np.ndarray:
    out = np.frombuffer(small, np.uint8).astype(np.int64)
    out[np.frombuffer(large, np.int64)] = np.frombuffer(values, np.int64)
    return out


def _seven(data: memoryview) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 7)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :7] = raw
    return out.view("<u8").ravel()


def _pair_shard(blobs: list[tuple[int, bytes]], word_shards: int) -> Iterator[tuple[int, int, int, bytes]]:
    loaded = [(batch, parted(data)) for batch, data in blobs]
    keys = [_spread(_values(*p[:2])) for _, p in loaded]
    sizes = [len(k) for k in keys]
    every, which = np.unique(np.concatenate(keys), return_inverse=True)
    which = which.astype(np.int32)
    del keys
    train = np.concatenate([np.unpackbits(np.frombuffer(p[3], np.uint8), count=n).astype(bool) for (_, p), n in zip(loaded, sizes)])
    counts = np.bincount(which[train], minlength=len(every))
    known = counts > 0
    trie = Trie(Trie.build(every[known], counts[known]))
    code = trie.find(every).astype(np.int32)[which]
    yield STATS, 0, 0, joined([np.array([0, 0, 0, int((counts == 1).sum())], np.int64).tobytes()])
    del every, which, counts, known, trie
    at = 0
    for (batch, p), n in zip(loaded, sizes):
        c, t, doc = code[at : at + n], train[at : at + n], _unpack_docs(p[2], n)
        at += n
        seen = c >= 0
        yield PART, batch, batch, _sums({CODES: np.bincount(doc[seen], c[seen]).astype(np.int64)})
        if not t.all():
            v, w = _seven(p[4]), _seven(p[5])
            doc, seen = doc[~t], seen[~t]
            word = np.where(seen, v, w)
            order = np.argsort(word, kind="stable")
            word, seen, doc = word[order], seen[order], doc[order]
            for shard, word, kind, doc in _slices(_range(word, word_shards), word, seen, doc):
                yield ASK, shard, batch, joined([np.ascontiguousarray(word.view(np.uint8).reshape(-1, 8)[:, :7]).tobytes(), np.packbits(kind).tobytes(), _pack_docs(doc)])


def _word_shard(blobs: list[tuple[int, bytes]], shard: int) -> Iterator[tuple[int, int, int, bytes]]:
    loaded = [(batch, parted(data)) for batch, data in blobs]
    words = [_values(*p[:2]) for _, p in loaded]
    uses = [EliasFano(p[2]).values().astype(np.int64) for _, p in loaded]
    docs = [_unpack_docs(p[3], int(u[-1])) for (_, p), u in zip(loaded, uses)]
    trains = [np.unpackbits(np.frombuffer(p[4], np.uint8)).astype(bool) for _, p in loaded]
    in_train = np.concatenate([np.add.reduceat(t[d].astype(np.int64), u[:-1]) for t, d, u in zip(trains, docs, uses)])
    every, which = np.unique(np.concatenate(words), return_inverse=True)
    counts = np.bincount(which, in_train, len(every)).astype(np.int64)
    yield STATS, 0, 0, joined([np.array([counts.sum(), (counts > 0).sum(), (counts == 1).sum(), 0], np.int64).tobytes()])
    held = counts > 0
    yield VOCABULARY, shard, -1, joined([EliasFano.encode(every[held]), *_pack_counts(counts[held])])
    base, plain = np.log10(counts + 0.1), _codes(counts)
    at = 0
    for (batch, _), w, u, doc, train in zip(loaded, words, uses, docs, trains):
        of = np.repeat(which[at : at + len(w)], np.diff(u))
        at += len(w)
        m, t = int(doc.max()) + 1, train[doc]
        yield PART, batch, batch, _sums({
            BASE: np.bincount(doc, base[of], m),
            KNOWN: np.bincount(doc[~t & (counts[of] > 0)], minlength=m),  # in training all words are known
            CONTEXT: np.bincount(doc[t], plain[of[t]], m).astype(np.int64),  # and each is the context of a seen pair once
        })


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[tuple[int, bytes]]]]:
    """Blobs of one kind and shard, which follow each other."""
    now, held = None, []
    for batch in batches:
        for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
            for kind, shard, of, data in zip(*(part.column(c).to_pylist() for c in ("kind", "shard", "batch", "data"))):
                if (kind, shard) != now:
                    if held:
                        yield *now, held
                    now, held = (kind, shard), []
                held.append((of, data))
    if held:
        yield *now, held


def _emit(rows: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == 64:
            yield _blobs(out)
            out = []
    if out:
        yield _blobs(out)


def _count(word_shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[int, int, int, bytes]]:
        for kind, shard, blobs in _grouped(batches):
            if kind == PAIRS:
                yield from _pair_shard(blobs, word_shards)
            elif kind == WORDS:
                yield from _word_shard(blobs, shard)
            else:
                yield from ((kind, batch, batch, data) for batch, data in blobs)

    yield from _emit(rows())


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Looks words up in their shard's vocabulary, all of a batch together; passes other blobs on."""

    def rows() -> Iterator[tuple[int, int, int, bytes]]:
        held: tuple[int, EliasFano, np.ndarray] | None = None
        asks: list[bytes] = []
        asker: tuple[int, int] | None = None

        def answered() -> Iterator[tuple[int, int, int, bytes]]:
            if asks:
                yield asked(held if held and held[0] == asker[0] else None, asker[1], asks)
                asks.clear()

        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                for kind, shard, of, data in zip(*(part.column(c).to_pylist() for c in ("kind", "shard", "batch", "data"))):
                    if asker != (shard, of) or kind != ASK:
                        yield from answered()
                    if kind == VOCABULARY:
                        words, *counts = parted(data)
                        held = shard, EliasFano(words), _unpack_counts(*counts)
                    elif kind == ASK:
                        asker = shard, of
                        asks.append(data)
                    else:
                        yield kind, shard, of, data
        yield from answered()

    def asked(held: tuple[int, EliasFano, np.ndarray] | None, of: int, asks: list[bytes]) -> tuple[int, int, int, bytes]:
        parts = [parted(a) for a in asks]
        words = [_seven(p[0]) for p in parts]
        context = np.concatenate([np.unpackbits(np.frombuffer(p[1], np.uint8), count=len(w)).astype(bool) for p, w in zip(parts, words)])
        doc = np.concatenate([_unpack_docs(p[2], len(w)) for p, w in zip(parts, words)])
        word = np.concatenate(words)
        count = np.zeros(len(word), np.int64)
        if held and held[1].n:
            at = held[1].successor(word)
            some = np.flatnonzero(at < held[1].n)
            some = some[held[1].get(at[some]) == word[some]]
            count[some] = held[2][at[some]]
        m, plain = int(doc.max()) + 1, _codes(count)
        known = ~context & (count > 0)
        return PART, of, of, _sums({
            UNSEEN: np.bincount(doc[~context], minlength=m),
            CONTEXT: np.bincount(doc[context], plain[context], m).astype(np.int64),
            BACKED: np.bincount(doc[known], plain[known], m).astype(np.int64),
            BACKED_KNOWN: np.bincount(doc[known], minlength=m),
        })

    yield from _emit(rows())


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each document of a batch; a row without a number of tokens for the statistics of shards."""
    names = ["doc_id", "train", "n_tokens", *(f"s{i}" for i in range(COLUMNS))]
    for kind_batch, rows in _by_batch(batches):
        meta = next((data for kind, data in rows if kind == META), None)
        if meta is None:
            stats = sum((np.frombuffer(parted(data)[0], np.int64) for kind, data in rows if kind == STATS), np.zeros(4, np.int64))
            sums = np.zeros((COLUMNS, 1))
            sums[:4, 0] = stats
            fixed = [pa.array([None], pa.int64()), pa.array([None], pa.bool_()), pa.array([None], pa.int64())]
        else:
            ids, tokens, known, train = parted(meta)
            ids, tokens = np.frombuffer(ids, np.int64), np.frombuffer(tokens, np.int64)
            known, train = (np.unpackbits(np.frombuffer(x, np.uint8), count=len(ids)).astype(bool) for x in (known, train))
            sums = np.zeros((COLUMNS, len(ids)))
            for kind, data in sorted(rows):  # in a fixed order, so that reruns agree to the last bit
                if kind == PART:
                    _add_sums(data, sums)
            fixed = [pa.array(ids, mask=~known), pa.array(train), pa.array(tokens)]
        yield pa.RecordBatch.from_arrays([*fixed, *(pa.array(s) for s in sums)], names=names)


def _by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    now, held = None, []
    for batch in batches:
        for kind, of, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "batch", "data"))):
            if of != now:
                if held:
                    yield now, held
                now, held = of, []
            held.append((kind, data))
    if held:
        yield now, held


def held_out(id: str) -> Column:
    """Whether crc32 of the id as text is divisible by 10 (no id: the empty text)."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score_texts(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``documents``.

    The model learns from the rows that are not held out. Words are split at white space, A-Z lower-cased; the end of
    a text counts as a token, so a null or empty text has one. ``n_known`` counts tokens that occur in training,
    ``train_tokens`` all of training. ``base_score`` is the log10 probability under additive smoothing by 0.1 of single
    tokens, ``score`` that under the pair model. Rows of a repeated or null id are scored one by one. Other columns
    are not read; an empty table gives an empty result, and without training rows every token is unknown.
    Words are told apart by 56-bit hashes, pairs by 56 bits as well.
    """
    rows = documents.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), (~held_out(id)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pair_shards, word_shards = 1 + size // PAIR_SHARD_BYTES, 1 + size // WORD_SHARD_BYTES
    sent = rows.mapInArrow(lambda b: _send(pair_shards, word_shards, b), BLOB)
    tasks = 3 * (pair_shards + word_shards)  # more than shards, as several may meet in one task
    counted = (
        sent.repartition(tasks, "kind", "shard").sortWithinPartitions("kind", "shard", "batch")
        .mapInArrow(lambda b: _count(word_shards, b), BLOB)
    )
    # a vocabulary has batch -1, so it comes before the questions to it
    answered = (
        counted.repartition(tasks, F.when(F.col("kind").isin(VOCABULARY, ASK), 1).otherwise(0), "shard")
        .sortWithinPartitions(F.when(F.col("kind").isin(VOCABULARY, ASK), 1).otherwise(0), "shard", "batch")
        .mapInArrow(_answer, BLOB)
    )
    by_document = (
        answered.withColumn("batch", F.when(F.col("kind") == STATS, -1).otherwise(F.col("batch")))
        .repartition("batch").sortWithinPartitions("batch")
        .mapInArrow(_collect, "doc_id long, train boolean, n_tokens long, " + ", ".join(f"s{i} double" for i in range(COLUMNS)))
    )
    parts = stored(by_document, "lm-scores")
    n, v, once, pairs_once = (int(x or 0) for x in parts.filter("n_tokens is null").agg(*(F.sum(f"s{i}") for i in range(4))).first())
    g, u = (pairs_once + 1) / (n + 2), (once + 1) / (n + 2)
    log = [float(np.log10(x)) for x in (1 - g, g, (1 - u) / max(n, 1), u, n + 0.1 * (v + 1))]
    c = [F.col(f"s{i}") for i in range(COLUMNS)]
    seen, unknown = F.col("n_tokens") - c[UNSEEN], c[UNSEEN] - c[BACKED_KNOWN]
    score = (c[CODES] - c[CONTEXT] + c[BACKED]) / STEPS + seen * log[0] + c[UNSEEN] * log[1] + c[BACKED_KNOWN] * log[2] + unknown * log[3]
    return parts.filter("n_tokens is not null").select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        F.when(F.col("train"), F.col("n_tokens")).otherwise(c[KNOWN].cast("long")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (c[BASE] - F.col("n_tokens") * log[4]).alias("base_score"),
        score.alias("score"),
    )

"""Scores of texts under a weighted backoff automaton of byte n-grams, with a word-frequency base score.

The model reads a text as its words in lower case (A-Z only), each followed by a space, and one end sign. Its states
are the contexts of up to five bytes seen in training, its arcs the n-grams of up to six bytes seen in training, and
between words also the words seen in training. An arc carries a smoothed probability: of a byte by absolute discounting
interpolated with all shorter contexts, of a word by its share of the training tokens interpolated with its spelling.
Where a state has no arc, a failure arc carries the weight left for it: from a missing word to the word's spelling, from
a missing byte to the context without its first byte. One pass from left to right carries the state and adds up log
probabilities. What a byte costs in a state, over all failure arcs, is worked out once per n-gram of a block, so the pass
makes one lookup per byte.

Counting and scoring go by blocks of documents of bounded size. A block is read once and leaves its documents as word
numbers (by frequency, so frequent words take one byte), its vocabulary, and its distinct words and n-grams with
training counts. Counts are added up over all blocks, and each block gets back the totals of its own words and n-grams:
the part of the automaton its texts can reach. So nothing is broadcast or capped, and a key has at most one row per
block, however frequent it is. The number of distinct training words travels with the counts too: each word is counted
by one of its blocks.

Rows: null counts as empty; an empty text is the end sign alone. Texts of any length are scored whole; a block holds at
least one text. Without training rows every byte has probability 1/256 and the base score is 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.llm.common import column, utf8
from rankweave.session import materialize

ORDER = 6
DISCOUNT = 0.75
WORD_SHARE = 0.25  # of a token's probability that comes from word counts
ADDED = 0.1  # fixed value of the base score
BLOCK_BYTES = 32 << 20
STREAM_BYTES = 2 << 20
SLICE = 1 << 20
DOC_ROWS = 500
END, SPACE, ROOT = 10, 32, 1
DOC, WORD, GRAM, VOCABULARY = 0, 1, 2, 3
# An n-gram is one number: its bytes after a leading 1, so appending a byte is a shift and the empty context is 1.
MARK = np.array([1 << (8 * k) for k in range(ORDER + 1)], np.int64)


def without_first(grams: np.ndarray, order: int) -> np.ndarray:
    return (grams & (MARK[order - 1] - 1)) | MARK[order - 1]


def order_of(grams: np.ndarray) -> np.ndarray:
    return np.searchsorted(MARK, grams, side="right") - 1


def longest_grams(stream: np.ndarray) -> np.ndarray:
    """The longest n-gram that ends at each byte after the first; none reaches back over an end sign."""
    b = stream.astype(np.int64)
    at = np.arange(len(b))
    sign = np.maximum.accumulate(np.where(b == END, at, 0))
    order = np.minimum(at[1:] - sign[:-1] + 1, ORDER)
    window = np.zeros(max(len(b) - 1, 0), np.int64)
    for back in range(min(ORDER, len(b))):
        window[max(back - 1, 0) :] |= b[max(1 - back, 0) : len(b) - back] << (8 * back)
    return (window & (MARK[order] - 1)) | MARK[order]


def counted_grams(stream: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The longest n-grams of a stream that begins with an end sign and their counts, in slices of bounded size."""
    b = np.frombuffer(stream, np.uint8)
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(b), SLICE):
        before = min(start, ORDER - 1)
        grams = longest_grams(b[start - before : start + SLICE])
        key, count = np.unique(grams[max(before - 1, 0) :], return_counts=True)
        keys.append(key)
        counts.append(count)
    return _summed(keys, counts)


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**28 in one to four bytes each, seven bits a byte, the lowest first; the last byte is below 128."""
    n = numbers.astype(np.uint32)
    parts = np.stack([(n >> np.uint32(7 * i)) & np.uint32(127) for i in range(4)], axis=1).astype(np.uint8)
    more = np.stack([n >= (1 << (7 * i)) for i in range(1, 4)] + [np.zeros(len(n), bool)], axis=1)
    used = np.stack([np.ones(len(n), bool), *[n >= (1 << (7 * i)) for i in range(1, 4)]], axis=1)
    return (parts | (more.astype(np.uint8) << np.uint8(7)))[used].tobytes()


def unpacked_numbers(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.int64)
    if not len(b):
        return b
    last = b < 128
    number = np.concatenate([[0], np.cumsum(last)[:-1]])
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    return np.add.reduceat((b & 127) << (7 * (np.arange(len(b)) - starts[number])), starts)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)


def all_orders(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all n-grams from counts of the longest ones at each place."""
    order = order_of(grams)
    keys, totals = [], []
    lower = (np.empty(0, np.int64), np.empty(0, np.int64))
    for k in range(ORDER, 0, -1):
        own = order == k
        key, total = _summed([grams[own], lower[0]], [counts[own], lower[1]])
        keys.append(key)
        totals.append(total)
        lower = (without_first(key, k), total)
    return np.concatenate(keys), np.concatenate(totals)


class Block:
    """Documents of a block as word numbers, and what the block has seen of words and n-grams."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.words: dict[bytes, int] = {}
        self.docs: list[tuple[object, bool, np.ndarray]] = []
        self.streams: dict[bool, list[bytes]] = {True: [], False: []}
        self.pending = {True: 0, False: 0}
        self.grams: list[np.ndarray] = [np.array([ROOT], np.int64)]
        self.counts: list[np.ndarray] = [np.zeros(1, np.int64)]

    def add(self, doc_id: object, held_out: bool, text: bytes) -> None:
        words, known = text.lower().split(), self.words
        self.docs.append((doc_id, held_out, np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))))
        spelled = b" ".join([*words, b""]) + b"\n"
        self.streams[held_out].append(spelled)
        self.pending[held_out] += len(spelled)
        self.size += len(text) + 1
        if self.pending[held_out] >= STREAM_BYTES:
            self._count(held_out)

    def _count(self, held_out: bool) -> None:
        if self.streams[held_out]:
            grams, counts = counted_grams(b"\n" + b"".join(self.streams[held_out]))
            self.grams.append(grams)
            self.counts.append(np.zeros_like(counts) if held_out else counts)
            self.streams[held_out], self.pending[held_out] = [], 0

    def _counted(self, trained: bool) -> np.ndarray:
        ids = [np.empty(0, np.int32), *[x for _, held_out, x in self.docs if trained <= (not held_out)]]
        return np.bincount(np.concatenate(ids), minlength=len(self.words)).astype(np.int64)

    def closed(self) -> tuple[list[tuple], list[bytes], np.ndarray, np.ndarray]:
        """Documents as packed word numbers, words in order of their number, training counts of words, and numbers in
        alphabetical order of the words."""
        words = list(self.words)
        by_frequency = np.argsort(-self._counted(False), kind="stable")
        number = np.empty(len(words), np.int64)
        number[by_frequency] = np.arange(len(words))
        spelled = [words[i] for i in by_frequency.tolist()]
        docs = [(doc_id, held_out, packed_numbers(number[ids])) for doc_id, held_out, ids in self.docs]
        alphabetical = np.array(sorted(range(len(spelled)), key=spelled.__getitem__), np.int64)
        return docs, spelled, self._counted(True)[by_frequency], alphabetical

    def gram_rows(self) -> tuple[np.ndarray, np.ndarray]:
        for held_out in (True, False):
            self._count(held_out)
        grams, counts = all_orders(*_summed(self.grams, self.counts))
        return np.append(grams, ROOT), np.append(counts, 0)


def _gathered(docs: DataFrame) -> DataFrame:
    """Rows of four kinds: a document (doc_id, held_out, data: word numbers), a block's vocabulary (data), a word
    (key: its number, data: its spelling, n) and an n-gram (key, n) of a block."""
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("held_out", T.BooleanType()), T.StructField("data", T.BinaryType()), T.StructField("key", T.LongType()),
        T.StructField("n", T.LongType())])
    types = {"held_out": pa.bool_(), "data": pa.binary(), "key": pa.int64(), "n": pa.int64()}

    def rows(kind: int, block: int, count: int, id_type: pa.DataType, **given) -> pa.RecordBatch:
        filled = {"kind": [kind] * count, "block": [block] * count, **given}
        kinds = {"kind": pa.int32(), "block": pa.int64(), "doc_id": id_type, **types}
        return pa.RecordBatch.from_arrays([pa.array(filled[f], kinds[f]) if f in filled else pa.nulls(count, kinds[f]) for f in schema.names], names=schema.names)

    def written(block: Block, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        found, spelled, counts, alphabetical = block.closed()
        for start in range(0, len(found), DOC_ROWS):
            doc_ids, held, data = zip(*found[start : start + DOC_ROWS], strict=True)
            yield rows(DOC, block.number, len(data), id_type, doc_id=doc_ids, held_out=held, data=data)
        yield rows(VOCABULARY, block.number, 1, id_type, data=[zlib.compress(b" ".join(spelled), 1)])
        yield rows(WORD, block.number, len(spelled), id_type, key=alphabetical, data=[spelled[i] for i in alphabetical.tolist()], n=counts[alphabetical])
        grams, counts = block.gram_rows()
        yield rows(GRAM, block.number, len(grams), id_type, key=grams, n=counts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, block, id_type = TaskContext.get().partitionId() << 32, 0, None, None
        for batch in batches:
            id_type = batch.column("doc_id").type
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for doc_id, held_out, text in zip(ids, held, utf8(batch.column("text")), strict=True):
                if block is None:
                    block, made = Block(first + made), made + 1
                block.add(doc_id, held_out, text)
                if block.size >= BLOCK_BYTES:
                    yield from written(block, id_type)
                    block = None
        if block is not None:
            yield from written(block, id_type)

    return docs.mapInArrow(read, schema)


class Automaton:
    """States, arcs and failure arcs from n-gram counts (gram, c) and context counts (total, kinds) of the same grams.

    `weights` has, for every n-gram given, the log probability of its last byte in the state of the bytes before it:
    the arc's own, or that of the failure arcs down to the first state with an arc and of the arc there.
    """

    def __init__(self, grams: np.ndarray, c: np.ndarray, total: np.ndarray, kinds: np.ndarray):
        sort = np.argsort(grams)
        self.grams, self.c, self.total = grams[sort], c[sort], total[sort].astype(float)
        grams, c, total, kinds = self.grams, self.c, self.total, kinds[sort].astype(float)
        order = order_of(grams)
        root = np.searchsorted(grams, ROOT)
        self.floor = float(np.log10(DISCOUNT * kinds[root] / 256 / total[root] if total[root] > 0 else 1 / 256))
        self.failures = np.log10(np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0))
        p, self.weights = np.zeros(len(grams)), np.full(len(grams), self.floor)
        for k in range(1, ORDER + 1):
            own = np.flatnonzero(order == k)
            before = np.searchsorted(grams, grams[own] >> 8)
            lower = np.searchsorted(grams, without_first(grams[own], k)) if k > 1 else None
            base = p[lower] if k > 1 else np.full(len(own), 1 / 256)
            seen = c[own] > 0
            smoothed = (c[own] - DISCOUNT + DISCOUNT * kinds[before] * base) / np.maximum(total[before], 1)
            p[own] = np.where(seen, smoothed, 0.0)
            fallen = self.failures[before] + self.weights[lower] if k > 1 else np.full(len(own), self.floor)
            self.weights[own] = np.where(seen, np.log10(np.where(seen, smoothed, 1.0)), fallen)

    def passed(self, grams: np.ndarray) -> np.ndarray:
        """Weights of known n-grams."""
        return self.weights[np.searchsorted(self.grams, grams)]

    @cached_property
    def arcs(self) -> dict[int, float]:
        return dict(zip(self.grams[self.c > 0].tolist(), self.weights[self.c > 0].tolist(), strict=True))

    @cached_property
    def backoff(self) -> dict[int, float]:
        return dict(zip(self.grams[self.total > 0].tolist(), self.failures[self.total > 0].tolist(), strict=True))

    @property
    def start(self) -> int:
        return self._state(1 << 8 | END)

    def _state(self, gram: int) -> int:
        """The longest context at the end of an n-gram that is a state."""
        while gram != ROOT and gram not in self.backoff:
            gram = shorter(gram)
        return gram

    def walk(self, state: int, symbols: bytes) -> tuple[float, int]:
        """Log probability of any bytes from a state on, and the state after them, one byte at a time."""
        total = 0.0
        for symbol in symbols:
            while (arc := self.arcs.get(state << 8 | symbol)) is None and state != ROOT:
                total += self.backoff[state]
                state = shorter(state)
            if arc is None:
                total += self.floor
                continue
            total += arc
            state = state << 8 | symbol
            state = self._state(shorter(state) if state >= MARK[ORDER] else state)
        return total, state


def shorter(gram: int) -> int:
    """An n-gram without its first byte."""
    mark = 1 << (gram.bit_length() - 9)
    return gram & (mark - 1) | mark


class BlockScorer:
    """Scores of a block's texts, given as word numbers: all of them in one pass from left to right.

    The state between two bytes is the window of the bytes before, which moves along with the pass. Slices of the pass
    overlap by as many tokens as a state can see, so that states carry over.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray, ends: int, tokens: int, automaton: Automaton):
        spelled = [*[w + b" " for w in words], b"\n"]
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(w) for w in spelled], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.end = len(words)
        counts = np.append(counts, ends)
        self.log_counts, self.known = np.log10(counts + ADDED), counts > 0
        self.arcs = WORD_SHARE * counts / max(tokens, 1)
        self.failure = 1.0 - WORD_SHARE if tokens else 1.0
        self.automaton = automaton

    def _token_scores(self, tokens: np.ndarray, before: int) -> np.ndarray:
        """Log probabilities of tokens, of which the first `before` (one at least) are there for the state only."""
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        stream = self.bytes[np.repeat(self.offsets[tokens] - ends + lengths, lengths) + np.arange(ends[-1])]
        from_ = ends[before - 1]
        weights = self.automaton.passed(longest_grams(stream)[from_ - 1 :])
        spelling = np.add.reduceat(weights, (ends - lengths)[before:] - from_)
        arcs = self.arcs[tokens[before:]]
        with np.errstate(divide="ignore"):
            mixed = np.log10(arcs + self.failure * 10.0**spelling)
        return np.where(arcs > 0, mixed, np.log10(self.failure) + spelling)

    def scores(self, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, sum of the log counts with what is added, score."""
        sizes = np.array([len(t) + 1 for t in texts])
        tokens = np.concatenate([[self.end], *[x for t in texts for x in (t, [self.end])]]).astype(np.int64)
        parts, start = [], 1
        bytes_ = np.cumsum(self.lengths[tokens])
        while start < len(tokens):
            stop = max(start + 1, int(np.searchsorted(bytes_, bytes_[start - 1] + SLICE)))
            before = min(start, ORDER - 1)
            parts.append(self._token_scores(tokens[start - before : stop], before))
            start = stop
        first = np.cumsum(sizes) - sizes

        def added(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, first)

        return sizes, added(self.known[tokens[1:]].astype(np.int64)), added(self.log_counts[tokens[1:]]), added(np.concatenate(parts))


def _bundled(counted: DataFrame, kind: int) -> DataFrame:
    """(block, kind, numbers, leads): the counted rows of a block that lie in one batch as one array of 64-bit numbers.

    Rows are (block, leads, then numbers); `leads` counts the trained keys that this block stands for.
    """
    names = counted.columns[2:]

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            leads = batch.column("leads").to_numpy(zero_copy_only=False)
            table = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).astype("<i8")
            order = np.argsort(block, kind="stable")
            blocks, starts = np.unique(block[order], return_index=True)
            ends = [*starts[1:].tolist(), len(order)]
            parts = [order[a:b] for a, b in zip(starts.tolist(), ends, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(blocks, pa.int64()), "kind": pa.array([kind] * len(blocks), pa.int32()),
                "numbers": pa.array([zlib.compress(np.ascontiguousarray(table[p].T).tobytes(), 1) for p in parts], pa.binary()),
                "leads": pa.array([int(leads[p].sum()) for p in parts], pa.int64())})

    return counted.mapInArrow(bundle, "block long, kind int, numbers binary, leads long")


def _counts(gathered: DataFrame) -> DataFrame:
    """Bundles of every block's words (number, c) and n-grams (gram, c, total, kinds) with counts over all blocks."""

    def over(kind: int, key: str) -> DataFrame:
        whole = W.partitionBy(key)  # at most one row per block
        lead = (F.min("block").over(whole) == F.col("block")) & (F.sum("n").over(whole) > 0)
        rows = gathered.filter(F.col("kind") == kind).select("block", key, *({"key"} - {key}), "n")
        return rows.select("block", lead.cast("int").alias("leads"), "key", F.sum("n").over(whole).alias("c"))

    words, grams = over(WORD, "data"), over(GRAM, "key")
    # Both uses of the n-grams share one shuffle as long as no condition on the key can move below it: the empty n-gram is never
    # counted, so it leads nowhere, and a key that cannot be null gets no check of its own from the join.
    context = F.coalesce(F.shiftright("key", 8), F.lit(0)).alias("key")
    contexts = grams.filter("leads = 1").groupBy(context).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
    known = grams.join(contexts, "key", "left").select(
        "block", "leads", "key", "c", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kinds", F.lit(0)).alias("kinds"))
    return _bundled(words, WORD).unionByName(_bundled(known, GRAM))


def _read_bundles(stats: pa.Table, kind: int, columns: int) -> np.ndarray:
    mine = stats.filter(pa.compute.equal(stats.column("kind"), kind)).column("numbers").to_pylist()
    parts = [np.frombuffer(zlib.decompress(x), "<i8").reshape(columns, -1) for x in mine]
    return np.concatenate(parts, axis=1) if parts else np.empty((columns, 0), np.int64)


def score_documents(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    The model learns from the rows whose `held_out` is false.
    """
    source = docs.select(column(key).alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), column(text).alias("text"))
    gathered = materialize(_gathered(source), "gathered")
    texts = gathered.filter(F.col("kind").isin(DOC, VOCABULARY)).select(F.col("block").alias("of"), "kind", "doc_id", "held_out", "data")
    ends = gathered.filter((F.col("kind") == DOC) & ~F.col("held_out")).count()
    tokens = ends + gathered.filter(F.col("kind") == WORD).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = T.StructType([
        source.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("log_counts", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("leads", T.LongType())])

    def score(block: pa.Table, stats: pa.Table) -> pa.Table:
        kind = block.column("kind").to_numpy()
        spelled = zlib.decompress(block.column("data")[int(np.flatnonzero(kind == VOCABULARY)[0])].as_py()).split()
        numbers, c = _read_bundles(stats, WORD, 2)
        counts = np.zeros(len(spelled), np.int64)
        counts[numbers] = c
        scorer = BlockScorer(spelled, counts, ends, tokens, Automaton(*_read_bundles(stats, GRAM, 4)))
        docs = block.filter(pa.array(kind == DOC))
        found = scorer.scores([unpacked_numbers(x) for x in docs.column("data").to_pylist()])
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = [pa.array(x, t) for x, t in zip(found, kinds, strict=True)]
        words = stats.filter(pa.compute.equal(stats.column("kind"), WORD))
        leads = np.zeros(docs.num_rows, np.int64)
        leads[0] = pa.compute.sum(words.column("leads")).as_py() or 0
        return pa.Table.from_arrays([docs.column("doc_id"), docs.column("held_out"), *columns, pa.array(leads)], names=out.names)

    scored = materialize(texts.groupBy("of").cogroup(_counts(gathered).groupBy("block")).applyInArrow(score, out), "scored")
    distinct = (scored.agg(F.coalesce(F.sum("leads"), F.lit(0))).first()[0]) + (ends > 0)
    whole = float(np.log10(tokens + ADDED * (distinct + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(whole)).alias("base_score"), "score")

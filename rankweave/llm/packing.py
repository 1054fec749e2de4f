"""Best-fit packing of tokenized documents into sequences by exact complements of lengths.

Only lengths decide, so the plan is made from the histogram of piece lengths: at most `capacity` numbers, whatever the
size of the corpus. Sums of one, two and three lengths are indexed. For the longest length left, the planner looks for a single length, then a pair, then a triple that
fills the gap exactly, and uses that combination as often as the counts of its lengths allow. Where no combination
fits exactly it adds the longest length that fits and looks again. Each step uses up a length, so a plan has a few
thousand patterns at most.

Spark then gives every piece its rank among the pieces of its length (places within a written block, plus the counts
of the blocks before it) and looks up the pattern that holds this rank. No task sees more than one block of pieces.

Rows: null and empty texts are one piece that holds the end id alone. Longer documents are cut into pieces of
`capacity` ids, the last piece may be shorter. Equal texts and repeated rows are packed like any others. An empty input
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from pathlib import Path
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.llm.bpe import OTHER_SPACE, printable_bytes
from rankweave.llm.common import column, give_back, of_worker
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.session import materialize

CAPACITY = 2048
END_ID = 0
CACHE = 150_000
SLICE_BYTES = 4 * 1024 * 1024
KEPT_LENGTH = 64
ASCII_SPACE = "\x1c\x1d\x1e\x1f"
PLAIN_LIMIT = "ɐ"  # Latin letters, whose classes no Unicode version changes


class WordTokenizer:
    """A tokenizer whose pieces never cross blanks, with the ids of words kept for the next time.

    Words of Latin letters are split here by the tokenizer's own pattern and only their pieces go through its model;
    everything else goes through the tokenizer as a whole.
    """

    def __init__(self, shared: dict):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(shared["file"])
        stages = json.loads(shared["file"])
        splits = [x for x in (stages["pre_tokenizer"] or {}).get("pretokenizers", ()) if x["type"] == "Split"]
        kinds = [x["type"] for x in (stages["normalizer"] or {}).get("normalizers", ())]
        self.known_form = kinds == ["NFC", "Replace", "Lowercase"] and len(splits) == 1 and splits[0]["invert"]
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"]) if self.known_form else None
        self.shown = {b: c for c, b in printable_bytes().items()}
        self.other_space = re.compile(f"[{OTHER_SPACE}]")
        self.words = _Known(self._word)
        self.pieces = _Known(self._piece)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() and piece.isprintable() else "".join(self.shown[b] for b in piece.encode())
        return array("i", [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word in the tokenizer's normal form: NFC and lower case."""
        pieces = self.pieces
        if word.isalpha():
            return pieces[word]
        stem, last = word[:-1], word[-1:]
        if stem.isalpha() and last in punctuation:
            return pieces[stem] + pieces[last]
        return b"".join(map(pieces.__getitem__, self.pattern.findall(word)))

    def _normal(self, text: str) -> str | None:
        """The normal form of a text that can be split here: known form, no special token, blanks that all libraries
        take for blanks, letters of one class everywhere. None for any other text."""
        if not self.known_form or "<|" in text:
            return None
        if text.isascii():  # other blanks inside ASCII are four control characters
            return None if any(map(text.__contains__, ASCII_SPACE)) else text.lower()
        if self.other_space.search(text):
            return None
        try:
            text.encode("latin-1")  # composed already, and quicker to find out than the greatest character
        except UnicodeEncodeError:
            if max(text) >= PLAIN_LIMIT:
                return None
        return text.lower() if is_normalized("NFC", text) else self.tokenizer.normalizer.normalize_str(text)

    def encode(self, text: str) -> np.ndarray:
        normal = self._normal(text)
        if normal is None:
            return self._by_word(text)
        self.words.trim()
        self.pieces.trim()
        return np.frombuffer(b"".join(map(self.words.__getitem__, normal.split())), np.int32)

    def _by_word(self, text: str) -> np.ndarray:
        """Words on their own where the text's blanks allow it, each in the normal form or by the library."""
        if self.other_space.search(text) or not self.known_form:
            return self._library(text)
        parts = []
        for word in text.split():
            normal = self._normal(word)
            parts.append(self._library(word) if normal is None else np.frombuffer(self.words[normal], np.int32))
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def forget(self) -> None:
        """Gives back the memory of known words, so that a worker that waits for its next task holds little."""
        for known in (self.words, self.pieces):
            known.clear()
            known.older = {}

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)


class _Known(dict):
    """Ids of words or pieces met before, in two generations: when the newer is full it becomes the older, so what
    occurs often stays. Long ones are not kept."""

    def __init__(self, function: Callable[[str], bytes]):
        super().__init__()
        self.function = function
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= KEPT_LENGTH:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()


def share(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file on every executor; its size is that of the file."""
    return spark.sparkContext.broadcast({"file": Path(path).read_text(encoding="utf-8")})


def tokenized(docs: DataFrame, tokenizer: Broadcast, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
              end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: the key, piece, start, length, ids_crc32 (and ids), with the writing block and the piece's
    place among the block's pieces of its length."""
    source = docs.select(column(key).alias("doc_id"), column(text).alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("place", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of rows with a bounded number of bytes of text, or one long text; so many ids are held at a time."""
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                before = size[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
                yield batch.slice(at, end - at)
                at = end

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = of_worker(tokenizer, "encoder", WordTokenizer)
        try:
            yield from pieces_of(batches, encoder)
        finally:
            encoder.forget()
            give_back()

    def pieces_of(batches: Iterator[pa.RecordBatch], encoder: WordTokenizer) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        block = TaskContext.get().partitionId()
        for batch in slices(batches):
            of_doc, numbers, starts, lengths, crcs, places, parts = [], [], [], [], [], [], []
            for row, text_ in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encoder.encode(text_ or ""), np.int32(end_id))
                for number, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    of_doc.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(len(part))
                    crcs.append(zlib.crc32(part.astype("<u4").tobytes()))
                    places.append(int(seen[len(part)]))
                    seen[len(part)] += 1
                    if with_ids:
                        parts.append(part)
            if not of_doc:
                continue
            columns = [batch.column("doc_id").take(pa.array(of_doc, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                       pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array([block] * len(of_doc), pa.int32()), pa.array(places, pa.int64())]
            if with_ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts), pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(cut, schema)


class Planner:
    """Combinations of lengths that fill sequences, from counts by length.

    `pair_at` and `triple_at` index the sums of pairs and triples: for each sum, the first combination that may still be
    there, in the order in which they are wanted. Lengths only ever run out, so an entry moves on for good over
    combinations of lengths that have run out, and all look-ups of a sum together pass each combination once.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.stock = [0] * (capacity + 1)
        for length, n in counts.items():
            self.stock[length] = n
        self.have = list(self.stock)  # less what the pattern at hand takes
        self.pair_at = [1] * (capacity + 1)
        self.triple_at = [max(0, total - 2) for total in range(capacity + 1)]

    def _single(self, gap: int) -> list[int] | None:
        return [gap] if self.have[gap] else None

    def _pair(self, gap: int) -> list[int] | None:
        """Two lengths that add up to the gap, the longer one as long as possible."""
        stock, have, low = self.stock, self.have, self.pair_at[gap]
        while 2 * low <= gap:
            high = gap - low
            if not stock[low] or stock[high] <= (high == low):
                if low == self.pair_at[gap]:
                    self.pair_at[gap] += 1
            elif have[low] and have[high] > (high == low):
                return [high, low]
            low += 1
        return None

    def _triple(self, gap: int) -> list[int] | None:
        """Three lengths that add up to the gap: the longest as long as possible, with an indexed pair."""
        top = self.triple_at[gap]
        while 3 * top >= gap > 2:
            rest = None
            if self.have[top]:
                self.have[top] -= 1
                rest = self._pair(gap - top)
                self.have[top] += 1
            if rest:
                return [top, *rest]
            gone = not self.stock[top] or 2 * self.pair_at[gap - top] > gap - top
            if gone and top == self.triple_at[gap]:
                self.triple_at[gap] -= 1
            top -= 1
        return None

    def _exact(self, gap: int) -> list[int] | None:
        return self._single(gap) or self._pair(gap) or self._triple(gap)

    def _pattern(self, longest: int) -> list[int]:
        """One sequence that begins with `longest`; the counts are as before afterwards."""
        pattern, gap = [longest], self.capacity - longest
        self.have[longest] -= 1
        while gap:
            more = self._exact(gap)
            if more is None:
                fitting = next((length for length in range(gap, 0, -1) if self.have[length]), None)
                if fitting is None:
                    break
                more = [fitting]
            for length in more:
                self.have[length] -= 1
            pattern += more
            gap -= sum(more)
        for length in pattern:
            self.have[length] += 1
        return pattern

    def plan(self) -> list[tuple[int, list[int]]]:
        """(times, lengths) of each pattern; together they use every piece once."""
        patterns = []
        for longest in range(self.capacity, 0, -1):
            while self.have[longest]:
                pattern = self._pattern(longest)
                times = min(self.have[length] // n for length, n in Counter(pattern).items())
                for length in pattern:
                    self.have[length] -= times
                    self.stock[length] -= times
                patterns.append((times, pattern))
        return patterns


def slots(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each run of ranks of a length, in order: the sequence of its first rank and the offset there."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def _assign(length: Column, rank: Column, table: dict[str, np.ndarray]) -> Column:
    """struct<sequence_id, offset> of the piece with this rank among the pieces of its length."""

    def batches(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        first = np.searchsorted(table["length"], np.arange(table["length"].max(initial=0) + 2))
        for lengths, ranks in columns:
            of, at = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
            row = np.zeros(len(of), np.int64)
            for one in np.unique(of):
                mine = of == one
                runs = table["rank"][first[one] : first[one + 1]]
                row[mine] = first[one] + np.searchsorted(runs, at[mine], side="right") - 1
            sequence = table["sequence"][row] + at - table["rank"][row] if len(of) else at
            yield pa.StructArray.from_arrays([pa.array(sequence, pa.int64()), pa.array(table["offset"][row] if len(of) else at, pa.int64())], names=["sequence_id", "offset"])

    batches.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, "struct<sequence_id:bigint,offset:bigint>")(length, rank)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (length, block, place, ...) that are read from a written table."""
    by_block = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = by_block.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r.length: r.n for r in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(Planner(counts, capacity).plan())
    found = lookup_join(pieces, base, ["block", "length"], ["place"], fits_in_memory(base))
    ranked = found.withColumn("put", _assign(F.col("length"), F.col("base") + F.col("place"), table))
    return ranked.select(*[c for c in pieces.columns if c not in ("block", "place")], "put.sequence_id", "put.offset")


def pack(docs: DataFrame, tokenizer: Broadcast, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pieces of all documents with their sequence and offset; options as in `tokenized`."""
    return place(materialize(tokenized(docs, tokenizer, capacity=capacity, **options), "pieces"), capacity)

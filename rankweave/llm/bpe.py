"""Byte-level BPE: a backtracking encoder with exact merges, and decoding by an offset table.

An Aho-Corasick automaton finds all tokens in a piece of text in one pass. The encoder takes the longest token at each
place and checks it against its left neighbour: a pair is compatible if no merge across the boundary would have been
applied before the merges that made the two tokens. Where no token fits, the place is marked dead and the token before
it gives way to its next shorter one. A place is left for good at most once, so the work is linear in the matches.

Decoding looks up each id's slice of one byte string by a table of offsets.

Rows: null and empty texts have no ids. Special tokens in a text get their ids, as the tokenizer file asks. Texts of
any length are encoded whole. Ids outside the vocabulary raise an error in decoding. Columns of the input that share a
result's name give way to it.
"""

from __future__ import annotations

import json
import re
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession

from rankweave.llm.common import arrow_function, of_worker

CACHE = 250_000
KEPT_LENGTH = 64
NEVER = 1 << 40
# The public splitting pattern of byte-level BPE, and the white space outside ASCII blanks.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER_SPACE = r"\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = " \t\n\r\x0b\f"


def printable_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, and its byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> dict:
    """Tokens by id, merges in order and special tokens of a tokenizer file; a few MB, fixed by the file."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    as_byte = printable_bytes()
    special = {x["content"]: x["id"] for x in data.get("added_tokens", ())}
    spelled = data["model"]["vocab"]
    size = max([*spelled.values(), *special.values()]) + 1
    tokens = [b""] * size
    for text, i in spelled.items():
        tokens[i] = text.encode() if text in special else bytes(as_byte[c] for c in text)
    for text, i in special.items():
        tokens[i] = text.encode()
    pairs = [x.split(" ") if isinstance(x, str) else x for x in data["model"]["merges"]]
    merges = [(spelled[a], spelled[b], spelled[a + b]) for a, b in pairs]
    return {"tokens": tokens, "merges": merges, "special": special}


def exact_parts(vocabulary: dict) -> dict[int, tuple[int, int, int]]:
    """The last merge (left, right, rank) of each token that the merges build from its own bytes.

    A vocabulary may hold tokens that merging never makes: another merge takes one of their bytes first. They are left
    out, and no text is ever encoded with them.
    """
    rank: dict[tuple[int, int], tuple[int, int]] = {}
    for i, (left, right, made) in enumerate(vocabulary["merges"]):
        rank.setdefault((left, right), (i, made))
    special, of_byte, found = set(vocabulary["special"].values()), {}, {}
    for i, token in enumerate(vocabulary["tokens"]):
        if len(token) == 1 and i not in special:
            of_byte[token[0]] = i
    if len(of_byte) < 256:
        raise ValueError("the vocabulary does not cover every byte")
    for _, _, made in vocabulary["merges"]:
        if made in found:
            continue
        ids, last = [of_byte[b] for b in vocabulary["tokens"][made]], None
        while len(ids) > 1:
            best = min(((rank[p], at) for at, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rank), default=None)
            if best is None:
                break
            (order, to), at = best
            last = (ids[at], ids[at + 1], order)
            ids[at : at + 2] = [to]
        if ids == [made] and last:
            found[made] = last
    return found


class Decoder:
    """Ids to bytes by offsets into all tokens laid end to end."""

    def __init__(self, vocabulary: dict):
        tokens = vocabulary["tokens"]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        first, length = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        ends = np.cumsum(length)
        if not len(ends):
            return b""
        return self.bytes[np.repeat(first - ends + length, length) + np.arange(ends[-1])].tobytes()


class Encoder:
    def __init__(self, vocabulary: dict):
        import ahocorasick
        import regex

        special = vocabulary["special"]
        self.special = special
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.spelled = [token.decode("latin-1") for token in vocabulary["tokens"]]
        self.parts = vocabulary["parts"] if "parts" in vocabulary else exact_parts(vocabulary)
        self.ids = {
            x: i for i, x in enumerate(self.spelled)
            if (len(x) == 1 or i in self.parts) and not (x in special and special[x] == i)
        }
        self.merge: dict[int, int] = {}
        for rank, (left, right, _) in enumerate(vocabulary["merges"]):
            self.merge.setdefault(left << 32 | right, rank)
        self.tails = _Cache(lambda token: self._edge(token, 1))
        self.heads = _Cache(lambda token: self._edge(token, 0))
        self.shorter = _Cache(self._shorter)
        self.fits = _Cache(self._pair_fits)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for spelled, i in self.ids.items():
            self.automaton.add_word(spelled, i)
        self.automaton.make_automaton()
        self.pieces = regex.compile(PIECES)
        self.segments = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
        self.other_space = re.compile(f"[{OTHER_SPACE}]")
        self.piece_ids = _Cache(self._piece)
        self.segment_ids = _Cache(self._segment)

    def _edge(self, token: int, side: int) -> tuple[tuple[int, int], ...]:
        """The tokens that stood at one side of `token` as it was built, each with the rank of the merge that took it."""
        edge, taken = [(token, NEVER)], self.parts.get(token)
        while taken:
            token = taken[side]
            edge.append((token, taken[2]))
            taken = self.parts.get(token)
        return tuple(edge)

    def _pair_fits(self, pair: int) -> bool:
        """Whether the second token can follow the first: no merge across their boundary comes before both are built.

        Equal merges run from left to right, so one across the boundary loses to the same merge inside the left token
        and wins against the same merge inside the right one.
        """
        left, right = pair >> 32, pair & 0xFFFFFFFF
        merge, heads = self.merge, self.heads[right]
        for a, a_taken in self.tails[left]:
            for b, b_taken in heads:
                rank = merge.get(a << 32 | b)
                if rank is not None and rank < a_taken and rank <= b_taken:
                    return False
        return True

    def compatible(self, left: int, right: int) -> bool:
        return self.fits[left << 32 | right]

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper beginning of this one; -1 if there is none."""
        spelled = self.spelled[token]
        return next((i for n in range(len(spelled) - 1, 0, -1) if (i := self.ids.get(spelled[:n])) is not None), -1)

    def encode_bytes(self, piece: str) -> list[int]:
        """Ids of one piece, given with one character per byte.

        The longest tokens from the left are the answer when all neighbours are compatible, which is tried first.
        """
        if (whole := self.ids.get(piece)) is not None:
            return [whole]
        ids = [token for _, token in self.automaton.iter_long(piece)]
        fits, before = self.fits, ids[0] if ids else 0
        for token in ids[1:]:
            if not fits[before << 32 | token]:
                return self._backtrack(piece)
            before = token
        return ids

    def _backtrack(self, piece: str) -> list[int]:
        size, fits, spelled, shorter, longest = len(piece), self.fits, self.spelled, self.shorter, self.automaton.iter_long
        dead = bytearray(size + 1)
        ids: list[int] = []
        at, token = 0, next(longest(piece, 0))[1]
        while True:
            while token >= 0:
                end = at + len(spelled[token])
                if not dead[end] and (not ids or fits[ids[-1] << 32 | token]):
                    break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at = end
                if at == size:
                    return ids
                token = next(longest(piece, at))[1]
            else:
                dead[at] = 1
                token = ids.pop()
                at -= len(spelled[token])
                token = shorter[token]

    def _piece(self, piece: str) -> bytes:
        return array("i", self.encode_bytes(piece if piece.isascii() else piece.encode().decode("latin-1"))).tobytes()

    def _segment(self, segment: str) -> bytes:
        return b"".join(map(self.piece_ids.__getitem__, self.pieces.findall(segment)))

    def _plain(self, text: str) -> bytes:
        if self.other_space.search(text):
            return self._segment(text)
        # A blank after another character always begins a new piece, so segments can be encoded on their own.
        segments = self.segments.findall(text)
        self._trim()
        return b"".join(map(self.segment_ids.__getitem__, segments))

    def _trim(self):
        """Between texts, caches that have grown past their bound are emptied."""
        for cache in (self.segment_ids, self.piece_ids, self.fits):
            if len(cache) > CACHE:
                cache.clear()

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        if not self.special or not self.at_special.search(text):
            return self._plain(text)
        parts = self.at_special.split(text)
        return b"".join(np.int32(self.special[x]).tobytes() if k % 2 else self._plain(x) for k, x in enumerate(parts) if x)


class _Cache(dict):
    """Results by argument; long texts are not kept."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        value = self.function(key)
        if isinstance(key, int) or len(key) <= KEPT_LENGTH:
            self[key] = value
        return value


def share(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary on every executor; its size is that of the tokenizer file."""
    vocabulary = read_vocabulary(path)
    return spark.sparkContext.broadcast(vocabulary | {"parts": exact_parts(vocabulary)})


def _as_lists(coded: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(x) // 4 for x in coded]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32), pa.int32()))


def encode(text: Column, vocabulary: Broadcast) -> Column:
    """array<int> of ids."""

    def make():
        encoder = of_worker(vocabulary, "encoder", Encoder)
        return lambda texts: _as_lists([encoder.encode(x or "") for x in texts.to_pylist()])

    return arrow_function(make, "array<int>")(text)


def decode(ids: Column, vocabulary: Broadcast) -> Column:
    """The text of array<int> ids; bytes that are not UTF-8 become replacement characters. Null gives empty text."""

    def make():
        decoder = of_worker(vocabulary, "decoder", Decoder)

        def apply(lists: pa.Array) -> pa.Array:
            texts = []
            for x in lists:
                texts.append(decoder.decode(np.asarray(x.values, np.int64)).decode("utf-8", "replace") if x.is_valid else "")
            return pa.array(texts, pa.string())

        return apply

    return arrow_function(make, "string")(ids)


def round_trip(text: Column, vocabulary: Broadcast) -> Column:
    """struct<ids, decoded>: both ways in one worker, so an executor holds one vocabulary per task."""

    def make():
        encoder, decoder = of_worker(vocabulary, "encoder", Encoder), of_worker(vocabulary, "decoder", Decoder)

        def apply(texts: pa.Array) -> pa.Array:
            coded = [encoder.encode(x or "") for x in texts.to_pylist()]
            decoded = [decoder.decode(np.frombuffer(x, np.int32)).decode("utf-8", "replace") for x in coded]
            return pa.StructArray.from_arrays([_as_lists(coded), pa.array(decoded, pa.string())], names=["ids", "decoded"])

        return apply

    return arrow_function(make, "struct<ids:array<int>,decoded:string>")(text)

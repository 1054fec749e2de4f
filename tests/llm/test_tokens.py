import random
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankweave.llm import bpe, common, packing

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = "aaab  \n\n\t\r\x0b\x1c\x85\xa0  sééſKİiΣς中\U0001f600²٣_-.<|endoftext|> the don't I'LL"


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(BYTE))


@pytest.fixture(scope="module")
def word_tokenizer():
    return packing.WordTokenizer({"file": open(WORD, encoding="utf-8").read()})


def pieces_of(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 60))) for _ in range(n)]


EDGES = ["", "a" * 3000, " " * 500, "<|endoftext|>", "x<|endoftext|> y<|startoftext|>z", "\n\n a", "a \n\nb", "\x00\x7f"]


@pytest.mark.parametrize("text", [*EDGES, "".join(pieces_of(1, 300))])
def test_bytes_as_the_library(encoder, text):
    library = Tokenizer.from_file(BYTE)
    ids = np.frombuffer(encoder.encode(text), np.int32)
    wanted = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == wanted
    decoded = bpe.Decoder(bpe.read_vocabulary(BYTE)).decode(ids).decode("utf-8", "replace")
    assert decoded == library.decode(wanted, skip_special_tokens=False) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(encoder, word_tokenizer, text):
    assert np.frombuffer(encoder.encode(text), np.int32).tolist() == Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids
    assert word_tokenizer.encode(text).tolist() == Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids


def test_words_as_the_library(word_tokenizer):
    library = Tokenizer.from_file(WORD)
    for text in [*EDGES, *pieces_of(2, 300)]:
        assert word_tokenizer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def merged_by_rank(merges, ids):
    rank = {(a, b): (i, made) for i, (a, b, made) in reversed(list(enumerate(merges)))}
    while True:
        best = min((rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank) if any(p in rank for p in zip(ids, ids[1:])) else None
        if best is None:
            return ids
        i = best[1]
        ids = ids[:i] + [rank[ids[i], ids[i + 1]][1]] + ids[i + 2:]


def test_backtracking_on_a_small_vocabulary():
    singles = [bytes([b]) for b in range(256)]
    tokens, merges = list(singles), []
    for a, b in (("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("ab", "a"), ("aa", "aa"), ("ba", "b"), ("aab", "ab")):
        one, two = tokens.index(a.encode()), tokens.index(b.encode())
        tokens.append((a + b).encode())
        merges.append((one, two, len(tokens) - 1))
    encoder = bpe.Encoder({"tokens": tokens, "merges": merges, "special": {}})
    for n in range(1, 11):
        for bits in range(2**n):
            text = "".join("ab"[bits >> i & 1] for i in range(n))
            wanted = merged_by_rank(merges, [ord(c) for c in text])
            assert encoder.encode_bytes(text) == wanted == encoder._backtrack(text), text


def test_columns(spark, hard, texts):
    vocabulary = bpe.share(spark, BYTE)
    rows = hard.select("doc_id", "text", bpe.round_trip(F.col("text"), vocabulary).alias("both"), bpe.encode(F.col("text"), vocabulary).alias("ids")).collect()
    library = Tokenizer.from_file(BYTE)
    for r in rows:
        assert r.ids == r.both.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.both.decoded == (r.text or "")
    again = spark.createDataFrame([([15496],), ([],), (None,)], "ids array<int>").select(bpe.decode(F.col("ids"), vocabulary).alias("t")).collect()
    assert [r.t for r in again] == [library.decode([15496]), "", ""]


def check_packing(rows, texts_by_id, capacity):
    library, pieces, sequences = Tokenizer.from_file(WORD), defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, of in texts_by_id.items():
        wanted = []
        for text in of:
            ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
            wanted += [(s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())) for s in range(0, len(ids), capacity)]
        assert sorted(pieces[doc_id]) == sorted(wanted)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack_hard_rows(spark, hard, hard_rows, nothing):
    shared = packing.share(spark, WORD)
    by_id = defaultdict(list)
    for r in hard_rows:
        by_id[r[0]].append(r[1] or "")
    for capacity in (7, 64, 2048):
        check_packing(packing.pack(hard, shared, capacity).collect(), by_id, capacity)
    rows = packing.pack(hard.filter("doc_id = 1"), shared, with_ids=True).collect()
    assert zlib.crc32(np.array(rows[0].ids, "<u4").tobytes()) == rows[0].ids_crc32
    assert packing.pack(nothing, shared).count() == 0


def fewest_bins(lengths, capacity):
    """By trying every partition of the pieces in order."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[i] <= capacity and bins[j] not in bins[:j]:
                place(i + 1, [*bins[:j], bins[j] + lengths[i], *bins[j + 1:]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def planned(lengths, capacity):
    counts = {x: lengths.count(x) for x in set(lengths)}
    patterns = packing.Planner(counts, capacity).plan()
    used = [x for times, pattern in patterns for x in pattern * times]
    assert sorted(used) == sorted(lengths) and all(sum(p) <= capacity for _, p in patterns)
    return sum(times for times, _ in patterns)


def test_plans_are_near_the_fewest():
    for lengths in combinations_with_replacement(range(1, 8), 5):
        assert planned(list(lengths), 8) <= fewest_bins(sorted(lengths, reverse=True), 8) + 1
    draw = random.Random(5)
    many = [draw.randint(1, 2048) for _ in range(5000)]
    assert planned(many, 2048) <= -(-sum(many) // 2048) * 1.01


def test_exact_complements_are_found():
    assert planned([1500, 548], 2048) == 1
    assert planned([1500, 300, 248], 2048) == 1
    assert planned([1100, 400, 300, 248] * 50, 2048) == 50
    assert planned([1024] * 7, 2048) == 4


def test_a_task_gives_unused_memory_back_when_it_ends(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(True))
    function = common.arrow_function(lambda: lambda x: pc.utf8_upper(x), "string").func
    results = function(iter([pa.array(["a"]), pa.array(["b", None])]))
    assert next(results).to_pylist() == ["A"] and not calls
    assert [x.to_pylist() for x in results] == [["B", None]] and calls == [True]

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from rankweave.llm import fingerprints as fp
from rankweave.llm.queries import QUERIES

from .conftest import FOLDER, prose


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def plain_sketch(text, k=fp.K, width=fp.WIDTH):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
    found = set()
    for i in range(max(1, len(words) - width + 1) if words else 0):
        h = 42
        for w in words[i:i + width]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        found.add(signed(h))
    return sorted(found)[:k]


def plain_resemblance(a, b, k=fp.K):
    if not a or not b:
        return float(not a and not b)
    m = sorted(set(a) | set(b))[:k]
    return len(set(m) & set(a) & set(b)) / len(m)


def test_sketches_of_hard_rows(hard, texts, nothing):
    assert [r.s for r in hard.select(fp.sketch(F.col("text")).alias("s")).collect()] == [plain_sketch(t) for t in texts]
    assert nothing.select(fp.sketch(F.col("text")).alias("s")).count() == 0


def test_estimates(spark):
    pairs = [(prose(i, 600), prose(i, 300) + " " + prose(50 + i, 300)) for i in range(25)] + [("", ""), ("a", ""), ("a b", "a b"), (prose(1, 40), prose(1, 20))]
    df = spark.createDataFrame(pairs, "a string, b string").select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    rows = df.select("a", "b", fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("a"), F.col("b")).alias("c"), fp.distinct_runs(F.col("a")).alias("n")).collect()
    for (one, two), r in zip(pairs, rows, strict=True):
        assert r.r == plain_resemblance(r.a, r.b)
        x, y = plain_sketch(one, 10**6), plain_sketch(two, 10**6)
        if x:
            assert abs(r.c - len(set(x) & set(y)) / len(x)) < 0.2 and abs(r.n / len(x) - 1) < 0.35
    mean = sum(r.r for r in rows[:25]) / 25
    assert abs(mean - sum(plain_resemblance(plain_sketch(a, 10**6), plain_sketch(b, 10**6), 10**6) for a, b in pairs[:25]) / 25) < 0.03


def test_parts_merge_to_the_whole(spark):
    rows = [(g, prose(10 * g + i, 90)) for g in range(3) for i in range(8)] + [(None, prose(1, 20)), (7, "")]
    parts = spark.createDataFrame(rows, "g int, text string").select("g", fp.sketch(F.col("text")).alias("sketch"))
    merged = {r.g: r.sketch for r in fp.merge_groups(parts, ["g"]).collect()}
    for g in (0, 1, 2, None):
        assert merged[g] == sorted({h for k, t in rows if k == g for h in plain_sketch(t, 10**6)})[:fp.K]
    two = parts.filter("g = 0").limit(2).collect()
    df = spark.createDataFrame([(two[0].sketch, two[1].sketch)], "a array<long>, b array<long>")
    assert df.select(fp.merged(F.col("a"), F.col("b")).alias("m")).first().m == sorted({*two[0].sketch, *two[1].sketch})[:fp.K]


def test_next_row_over_blocks(spark):
    draw = random.Random(3)
    ids = draw.sample(range(-1000, 1000), 300)
    for keys, blocks in ((ids, 8), (ids, 1), (ids[:5], 8), ([4], 3), ([], 4), ([*ids, None], 6)):
        df = spark.createDataFrame([(k, f"t{k}") for k in keys], "k long, t string").repartition(5)
        rows = fp.with_next(df, "k", ["t"], blocks).collect()
        order = sorted(keys, key=lambda k: (k is not None, k))
        wanted = {k: f"t{order[(i + 1) % len(order)]}" for i, k in enumerate(order)}
        assert {r.k: r.next.t for r in rows} == wanted and len(rows) == len(keys)


def test_query_against_brute_force(spark):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    found = {r.doc_id: r for r in QUERIES["op10_bottom_k"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r, own, new = found[doc_id], plain_sketch(text), plain_sketch(edited)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == ",".join(f"{h % 2**64:x}" for h in own) and r.edited_fingerprint == ",".join(f"{h % 2**64:x}" for h in new)
        assert r.near_edited == plain_resemblance(own, new) and r.near_next == plain_resemblance(own, plain_sketch(after))


def test_next_row_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(3, "c", 1, 1, 1, 1), (1, "a", 2, 2, 2, 2), (2, "b", 3, 3, 3, 3)],
                               "k long, v string, _block long, _own long, _last long, next long")
    got = fp.with_next(df, "k", ["v"], 3)
    assert got.columns == ["k", "v", "_block", "_own", "_last", "next"]
    assert sorted((r.k, r["_block"], r["_own"], r["_last"], r.next.v) for r in got.collect()) == [(1, 2, 2, 2, "b"), (2, 3, 3, 3, "c"), (3, 1, 1, 1, "a")]


def test_next_row_with_null_and_repeated_keys(spark):
    rows = [(None, "x"), (2, "b"), (2, "b"), (2, "a"), (None, "y"), (5, None), (7, "z")]
    df = spark.createDataFrame(rows, "k long, v string")
    in_order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    wanted = sorted(((k, v, in_order[(i + 1) % len(rows)][1]) for i, (k, v) in enumerate(in_order)), key=str)
    for blocks in (1, 3, 8):
        got = [(r.k, r.v, r.next.v) for r in fp.with_next(df, "k", ["v"], blocks).collect()]
        assert sorted(got, key=str) == wanted

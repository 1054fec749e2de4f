import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import near_dedup
from rankweave.operators.components import connected_components

from .conftest import SCHEMA, document, prose


def plain_similarity(one, two):
    def weights(text):
        w = text.lower().split()
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    a, b = weights(one), weights(two)
    if not a or not b:
        return float(one == two)
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    both = a.keys() & b.keys()
    prob = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in both)
    return max(plain, prob)


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def changed(text, seed, n):
    draw, words = random.Random(seed), text.split()
    for i in draw.sample(range(len(words)), n):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def test_signature_agreement_estimates_similarity():
    shingler = near_dedup.Shingler(5)
    for one, two in ((prose(1, 80), prose(1, 50) + " " + prose(2, 30)), (prose(3, 40) * 3, prose(3, 40)), ("a b c d e " * 20 + prose(4, 30), "a b c d e " * 4 + prose(4, 30))):
        a, b = shingler.weights(one.encode()), shingler.weights(two.encode())
        of = np.repeat([0, 1], [len(a[0]), len(b[0])])
        signature = near_dedup.prob_minhash(of, np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 2, 4000)
        shared = np.intersect1d(a[0], b[0])
        weight = [dict(zip(*(x.tolist() for x in s), strict=True)) for s in (a, b)]
        exact = sum(1 / sum(max(weight[0].get(j, 0) / weight[0][i], weight[1].get(j, 0) / weight[1][i]) for j in weight[0].keys() | weight[1].keys()) for i in shared.tolist())
        assert abs((signature[0] == signature[1]).mean() - exact) < 0.035


@pytest.mark.parametrize("pair", [("", ""), ("a", ""), ("a b", "a b"), ("a b c d e f", "a b c d e g"), ("x y z w v " * 9, "x y z w v " * 3), (prose(5, 50), changed(prose(5, 50), 1, 1))])
def test_similarity_by_its_definition(pair):
    shingler = near_dedup.Shingler(5)
    got = near_dedup.similarity(*[shingler.weights(t.encode()) for t in pair])
    assert abs(got - (plain_similarity(*pair) if all(t.split() for t in pair) else 0.0)) < 1e-9


def test_signature_does_not_depend_on_the_batch():
    texts = [prose(i, 3 + 40 * i).encode() for i in range(12)] + [b"", b"one"]
    whole = near_dedup.signatures(texts, near_dedup.Shingler(5))
    assert all((near_dedup.signatures([t], near_dedup.Shingler(5))[0] == whole[i]).all() for i, t in enumerate(texts))


def chained():
    """Groups of copies, and a chain whose ends are unlike: every text is near the next one only."""
    texts = [prose(100 + i, 60) for i in range(12)]
    for i in range(8):
        texts += [changed(texts[i], 10 * i + j, 1) for j in range(6)]
    link = prose(200, 120)
    for i in range(10):
        texts.append(link)
        words = link.split()
        words[i * 11] = f"step{i}"
        words[i * 11 + 1] = f"step{i}b"
        link = " ".join(words)
    texts += [texts[0]] * 5 + [texts[-7]] * 3 + ["", "", None, "few words", "few words", "Few Words"]
    return texts


def expected(rows):
    ids = [r[0] for r in rows]
    text = {r[0]: r[1] or "" for r in rows}
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if text[a] == text[b] or (text[a].split() and text[b].split() and plain_similarity(text[a], text[b]) >= 0.8)]
    return roots(ids, links)


def test_classes_equal_brute_force(spark):
    rows = [document(i, t) for i, t in enumerate(chained())]
    random.Random(2).shuffle(rows)
    wanted = expected(rows)
    sizes = Counter(wanted.values())
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert {r.doc_id: r.class_id for r in found} == wanted
    assert all(r.class_rows == sizes[r.class_id] for r in found)
    kept = near_dedup.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(sizes)
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]


def test_torn_buckets_are_gone_through_again(spark, monkeypatch):
    """One band of one row puts unlike texts into one bucket; links among them must not depend on its smallest member."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "GROUP_BYTES", 400)
    texts = [changed(prose(300 + i % 3, 60), i, 1) for i in range(24)]
    rows = [document(i, t) for i, t in enumerate(texts)]
    real = near_dedup._buckets

    def one_bucket(sketches):
        merged = sketches.withColumn("bands", F.array(F.lit(7).cast("long")))
        return real(merged)

    monkeypatch.setattr(near_dedup, "_buckets", one_bucket)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in found} == expected(rows)


def test_hard_rows(hard, hard_rows, nothing):
    found = near_dedup.near_duplicates(hard).collect()
    by_text = defaultdict(set)
    for r in found:
        by_text[r.doc_id].add(r.class_id)
    assert len(found) == len(hard_rows)
    assert by_text[5] == by_text[6] == by_text[9] == by_text[1] == {1}
    assert by_text[2] == by_text[3] == by_text[11] == {2} and by_text[None] == {None} and by_text[4] == {4}
    assert by_text[7] == {7}  # white space alone equals no other text
    kept = near_dedup.keep_one(hard)
    assert kept.columns == hard.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, None, 4, 7, 8, 10, 12, 13, 14])
    assert near_dedup.near_duplicates(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def test_components(spark):
    draw = random.Random(9)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, j) for j in range(501, 560)]
    found = connected_components(spark.createDataFrame(links, "x long, y long")).collect()
    wanted = roots({n for a, b in links for n in (a, b) if a != b}, links)
    assert {r.node: r.root for r in found} == wanted and len(found) == len(wanted)
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def unevenly_repeated():
    """Pairs with plain Jaccard 1 and probability Jaccard below 0.3: a separator row once, and 300 times."""
    texts = []
    for i in range(8):
        base = prose(700 + i, 90)
        texts += [base + " |" * 5, base + " |" * 304]
    return texts


def only_plain(one, two):
    shingler = near_dedup.Shingler(5)
    (a, x), (b, y) = shingler.weights(one.encode()), shingler.weights(two.encode())
    assert (a == b).all()
    assert sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(len(a))) < 0.3


def test_links_by_plain_similarity_are_candidates(spark):
    texts = unevenly_repeated()
    for i in range(0, len(texts), 2):
        only_plain(texts[i], texts[i + 1])
    found = near_dedup.near_duplicates(spark.createDataFrame([document(i, t) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in found} == {i: i - i % 2 for i in range(len(texts))}


def test_links_by_plain_similarity_join_components(spark, monkeypatch):
    """In one bucket of unlike texts, the pairs across components are picked by the agreement of either signature."""
    real = near_dedup._buckets
    monkeypatch.setattr(near_dedup, "_buckets", lambda sketches: real(sketches.withColumn("bands", F.array(F.lit(7).cast("long")))))
    rows = [document(i, t) for i, t in enumerate(unevenly_repeated())]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in found} == {i: i - i % 2 for i in range(len(rows))}

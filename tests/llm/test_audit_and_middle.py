"""The filter audit and fill-in-middle against plain Python."""

import hashlib
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from rankweave.llm import filter_audit, middle, repeats

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(key, text, rate=50, spm_rate=80, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TRICKY = ["", " ", "a", " a", "a ", "<P>", "x <S> y", "<", "<<< P> <P", "S> M> a < b", "$1 \\1 $0 {2} ${x}", "ab cd ef", "\x1c \x85\n\n", "😀 中文 é é x",
          "\t\n\x0b\x0c\r ", "a\r\nb\n", "<P <S> <M", "(?i) [a-z]+ \\Q \\E", "a" * 50_000, "b " * 60_000, " " * 30_000 + "x"]


@pytest.mark.parametrize("rate, spm_rate", [(50, 80), (100, 50)])
def test_middle(spark, rate, spm_rate):
    rows = [(i, t, "r", "o") for i, t in enumerate(TRICKY * 4)] + [(None, "a b c", "r", "o"), (3, None, None, None), (3, "x y z", None, None), (3, "x y z", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, output string")
    made = middle.transform(df, rate=rate, spm_rate=spm_rate)
    assert made.columns == ["doc_id", "text", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, r.text, rate, spm_rate), r.text
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_middle_on_hard_and_empty_tables(spark, hard, nothing):
    got = middle.transform(hard).collect()
    assert len(got) == hard.count()
    assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, r.text) for r in got)
    assert middle.transform(nothing).count() == 0


def plain_mask(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    upper = len(re.findall("[A-Z]", text))
    return ((len(w) < 100) + 2 * (100 * len(set(w)) < 80 * len(w)) + 4 * (100 * upper > 10 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text)))


def plain_audit(docs, labels):
    """One document at a time, in every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    fails = []
    for d, t, lang in docs:
        mask = plain_mask(t or "")
        late = d is not None and d > first[t or ""]
        fails.append((d, lang or "", {x for i, x in enumerate("ABCD") if mask >> i & 1} | ({"E"} if late else set())))
    out = {}
    for part in {p for _, p, _ in fails}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = [(d, f) for d, p, f in fails if p == part]
            for step, x in enumerate(order, 1):
                removed = [d for d, f in left if x in f]
                mine = [f for _, p, f in fails if p == part and x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(removed)
                out[part, order, step] = [len(left), len(removed), len(mine) - len(removed), sum(f == {x} for f in mine),
                                          sum(d in good for d in removed), sum(d in toxic for d in removed), x]
        for key in out:
            if key[0] == part:
                out[key][-1] = shapley[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    got = filter_audit.audit(docs, labels).collect()
    assert len({(r.part, r.filter_order, r.step) for r in got}) == len(got)
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}


LABELS = [(1, 1, 0), (2, 0, None), (None, 1, 1), (5, 1, 1), (5, 0, 0), (6, None, 1), (9, 1, 0), (77, 1, 1)]


def test_audit(spark, hard, nothing):
    labels = spark.createDataFrame([(*x, "y") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    rows = [(r.doc_id, r.text, r.lang) for r in hard.collect()]
    assert audited(hard, labels) == plain_audit(rows, LABELS)
    assert audited(nothing, labels) == {}
    assert audited(hard, labels.limit(0)) == plain_audit(rows, [])


def test_audit_limits(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:99]), " ".join(words[:100]), " ".join(words[:80] * 2), " ".join((words[:80] + words[:20])), " ".join((words[:79] + words[:21])),
             "A" + "b" * 9, "A" * 2 + "b" * 9, "É" * 10, "x|y", "x!y", " ".join(words[:100]) + " "]
    rows = [(i, t, None if i % 2 else "de") for i, t in enumerate(texts * 3)] + [(40, texts[1], "de"), (40, texts[1], "de"), (None, texts[1], "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audited(docs, labels) == plain_audit(rows, LABELS)


def marks(spark, rows):
    df = spark.createDataFrame(rows, "k long, t string, at long")
    return {r["at"]: r["late"] for r in repeats.mark(df, F.col("k"), F.col("t"), {"at": F.col("at")}, "late").collect()}


def test_repeats_are_exact(spark, monkeypatch):
    """A filter of one block marks nearly all texts as possible repeats, a poor hash gives collisions: nothing changes."""
    rows = [(k, f"text {k % 700 if k % 3 else 0}", at) for at, k in enumerate(range(1500))] + [(0, "text 0", 2000), (None, "text 0", 2001), (7, None, 2002), (3, "", 2003)]
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(k, first.get(t or "", k))
    wanted = {at: k is not None and k > first[t or ""] for k, t, at in rows}
    assert marks(spark, rows) == wanted
    monkeypatch.setattr(repeats, "MOST_CELLS", repeats.BLOCK)
    assert marks(spark, rows) == wanted
    seeds, real = [], repeats.hashes

    def poor(text, seed):
        seeds.append(seed)
        return real(text, seed) if seed else [F.pmod(F.xxhash64(text), F.lit(5)).alias("_h"), F.lit(1).cast("long").alias("_g")]

    monkeypatch.setattr(repeats, "hashes", poor)
    assert marks(spark, rows) == wanted and max(seeds) > 0


def test_the_filter_clears_unique_texts(spark):
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 10 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"))
    rows = df.select(F.col("id").alias("_key"), F.col("t").alias("_text"), *repeats.hashes(F.col("t"), 0))
    cells = repeats.cells_for(20_000)
    left = repeats.possible(rows, repeats.met_twice(rows.select(*repeats.HASH), cells), cells).collect()
    assert sum(r["_text"] == "same" for r in left) == 2000
    assert len(left) < 2000 + 0.02 * 18_000

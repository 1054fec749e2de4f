"""Near-duplicates by ProbMinHash, banding and exact verification.

A text is a weighted set: its runs of five words, weighted by how often they occur. Every run has a Poisson process of
arrivals whose rate is its weight; each arrival falls on one of the signature's components, and a component keeps the
run that arrived there first. A run's process stops as soon as it has passed the latest of the first arrivals, so a
text takes about (runs + size x log size) arrivals. Two texts agree in a component with the probability Jaccard
similarity of their weighted sets. The same arrivals with every weight 1 give a second, plain signature, whose components
agree with the plain Jaccard similarity; it differs from the first where a text repeats a run.

Equal texts are taken together first (by MD5), and only one of them goes on. Bands of both signatures make buckets. Each
member of a bucket is compared with one member, its smallest: by exact shingles, in groups of bounded size. Verified
pairs are links and give components. Buckets whose members then lie in several components are gone through again: first
members outside a bucket's largest component are compared with a few members of it; then the pairs from
different components that are left and whose signatures of one kind agree enough are verified, in blocks of bounded size. So large
groups cost a few comparisons per member and bucket, and no pair of a shared bucket that could join two components is
left out.

A pair is a link when its probability Jaccard similarity or its plain Jaccard similarity reaches the threshold. A pair
at 0.8 in either shares no band with probability 2e-6 at most (25 bands of 4 from each signature).

Rows: words are runs without ASCII blanks, ASCII letters in lower case. A text with fewer words than a run has one run
of all its words. Null counts as empty; texts without words are alike only if equal. Every row of the input has a row
in the result, repeated rows included. A class is named by its smallest key that is not null. An empty input gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import arrow_function, column, mixed, packed, utf8, window_hashes
from rankweave.operators.components import connected_components
from rankweave.operators.joins import fits_in_memory, lookup_join
from rankweave.session import materialize

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 4
SIZE = BANDS * ROWS
LEAST_AGREEMENT = 0.6  # a pair at 0.8 agrees in fewer of 100 components with probability 1e-6
GROUP_BYTES = 8 << 20
GROUP_ROWS = 128
BLOCK = 512
TURNS, PICKS, FEW_PAIRS = 1, 4, 4
CHUNK = 200_000
CACHE = 150_000
STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Hashed runs of words of a text."""

    def __init__(self, width: int):
        import xxhash

        self.width, self.hash, self.words = width, xxhash.xxh3_64_intdigest, {}

    def _number(self, word: bytes) -> int:
        number = self.words[word] = self.hash(word)
        return number

    def runs(self, text: bytes) -> np.ndarray:
        """One hash per run, repeats included."""
        if len(self.words) > CACHE:
            self.words.clear()
        words, known = text.lower().split(), self.words
        if not words:
            return np.empty(0, np.uint64)
        numbers = [known[w] if w in known else self._number(w) for w in words]
        return window_hashes(np.array(numbers, np.uint64), min(self.width, len(numbers)))

    def weights(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distinct runs in order of their hash, and how often each occurs."""
        runs, counts = np.unique(self.runs(text), return_counts=True)
        return runs, counts.astype(float)


def prob_minhash(of: np.ndarray, runs: np.ndarray, weight: np.ndarray, texts: int, size: int = SIZE) -> np.ndarray:
    """Signatures (texts x size) of the weighted sets given as (text number, run, weight); 0 where a text has no run.

    All runs go through their arrivals side by side; a run leaves when its arrival is later than the latest first
    arrival of its text.
    """
    first = np.full(texts * size, np.inf)
    signature = np.zeros(texts * size, np.uint64)
    time = np.zeros(len(runs))
    latest = np.full(texts, np.inf)
    live, arrival = np.arange(len(runs)), 0
    while len(live):
        arrival += 1
        step = np.uint64(arrival * int(STEP) % 2**64)
        bits = mixed(runs[live] + step)
        gap = -np.log(((bits >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
        time[live] += gap / weight[live]
        live = live[time[live] < latest[of[live]]] if arrival > 1 else live
        bits = mixed((runs[live] ^ STEP) + step)
        place = of[live] * size + (bits % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, place, time[live])
        won = time[live] == first[place]
        signature[place[won]] = runs[live[won]]
        if arrival <= 4 or arrival % 4 == 0:
            latest = first.reshape(texts, size).max(axis=1)
            live = live[time[live] < latest[of[live]]]
    return signature.reshape(texts, size)


def signatures(texts: list[bytes], shingler: Shingler, size: int = SIZE) -> np.ndarray:
    """Signatures of texts (texts x 2 x size), by weight and with every weight 1; about CHUNK runs are held at a time."""
    out = np.zeros((len(texts), 2, size), np.uint64)
    sets: list[tuple[np.ndarray, np.ndarray]] = []
    start, held = 0, 0
    for i, text in enumerate(texts):
        sets.append(shingler.weights(text))
        held += len(sets[-1][0])
        if held >= CHUNK or i + 1 == len(texts):
            if held:
                of = np.repeat(np.arange(len(sets)), [len(runs) for runs, _ in sets])
                runs = np.concatenate([r for r, _ in sets])
                out[start : i + 1] = prob_minhash(of, runs, np.concatenate([w for _, w in sets]), len(sets), size)[:, None]
                repeat = np.flatnonzero([w.max(initial=1) > 1 for _, w in sets])
                if len(repeat):
                    runs = np.concatenate([sets[k][0] for k in repeat.tolist()])
                    of = np.repeat(np.arange(len(repeat)), [len(sets[k][0]) for k in repeat.tolist()])
                    out[start + repeat, 1] = prob_minhash(of, runs, np.ones(len(runs)), len(repeat), size)
            sets, start, held = [], i + 1, 0
    return out


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per band, different for different bands."""
    total = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None] * STEP, len(signature), axis=0)
    for i in range(rows):
        total = mixed(total + signature[:, i::rows][:, :bands])
    return total


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """The greater of the probability Jaccard similarity and the plain Jaccard similarity of two weighted sets."""
    (a, x), (b, y) = one, two
    shared, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    plain = len(shared) / (len(a) + len(b) - len(shared))
    # Sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i): j counts by x where x_j / y_j is the greater.
    ratio = x[at_a] / y[at_b]
    order = np.argsort(ratio, kind="stable")
    xs, ys, ratio = x[at_a][order], y[at_b][order], ratio[order]
    only_x, only_y = x.sum() - xs.sum(), y.sum() - ys.sum()
    begin = np.searchsorted(ratio, ratio, side="left")
    above = only_x + (xs.sum() - np.concatenate([[0.0], np.cumsum(xs)]))[begin]
    below = only_y + np.concatenate([[0.0], np.cumsum(ys)])[begin]
    return max(plain, float((1.0 / (above / xs + below / ys)).sum()))


def _sketch(text: Column) -> Column:
    """struct of the band hashes of both signatures (none for a text without words) and two bytes of each component, by
    weight (`short`) and with every weight 1 (`plain`, null where it is the same)."""

    def make():
        shingler = Shingler(WIDTH)

        def two_bytes(signature: np.ndarray) -> np.ndarray:
            return (mixed(signature) & np.uint64(0xFFFF)).astype("<u2")

        def apply(texts: pa.Array) -> pa.Array:
            both = signatures(utf8(texts), shingler)
            weighted, plain = both[:, 0], both[:, 1]
            empty, other = ~weighted.any(axis=1), (weighted != plain).any(axis=1)
            lists = [[] if e else b for e, b in zip(empty.tolist(), band_hashes(weighted).view(np.int64).tolist(), strict=True)]
            short, plain_short = [s.tobytes() for s in two_bytes(weighted)], [None] * len(lists)
            apart = np.flatnonzero(other)
            more = zip(apart.tolist(), band_hashes(plain[apart]).view(np.int64).tolist(), two_bytes(plain[apart]), strict=True)
            for i, bands, components in more:
                lists[i] = list(dict.fromkeys(lists[i] + bands))
                plain_short[i] = components.tobytes()
            return pa.StructArray.from_arrays(
                [pa.array(lists, pa.list_(pa.int64())), pa.array(short, pa.binary()), pa.array(plain_short, pa.binary())], names=["bands", "short", "plain"])

        return apply

    return arrow_function(make, "struct<bands:array<bigint>,short:binary,plain:binary>")(text)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b, bytes of a) whose texts reach the threshold.

    Each pair's text a goes to a group of its b; a b with many pairs gets several groups of about GROUP_BYTES and
    GROUP_ROWS each at most.
    """
    groups = F.ceil(F.greatest(F.sum("bytes") / F.lit(GROUP_BYTES), F.count(F.lit(1)) / F.lit(GROUP_ROWS))).cast("int")
    spread = materialize(pairs.groupBy("b").agg(F.greatest(F.lit(1), groups).alias("groups")), "groups")
    dealt = lookup_join(pairs, spread, ["b"], ["a"], fits_in_memory(spread)).withColumn("part", F.pmod(F.xxhash64("a"), F.col("groups")).cast("int"))
    left = dealt.select("a", "b", "part").join(texts.select(F.col("h").alias("a"), F.col("text").alias("text_a")), "a")
    right = texts.withColumnRenamed("h", "rep").join(spread.withColumnRenamed("b", "rep"), "rep").select(
        "rep", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("rep_part"), F.col("text").alias("text_b"))

    def compare(members: pa.Table, rep: pa.Table) -> pa.Table:
        shingler = Shingler(WIDTH)
        found = []
        if members.num_rows and rep.num_rows:
            other = shingler.weights(rep.column("text_b")[0].as_py().encode())
            for i, text in enumerate(members.column("text_a").to_pylist()):
                if similarity(shingler.weights(text.encode()), other) >= threshold - 1e-12:
                    found.append(i)
        return members.select(["a", "b"]).take(pa.array(found, pa.int64()))

    return left.groupBy("b", "part").cogroup(right.groupBy("rep", "rep_part")).applyInArrow(compare, "a binary, b binary")


def _buckets(sketches: DataFrame) -> DataFrame:
    """(bucket, h, bytes, rep, n) of every bucket with two texts or more; rep is its smallest text key."""
    held = sketches.select("h", "bytes", F.explode("bands").alias("bucket"))
    shared = held.groupBy("bucket").agg(F.min("h").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return held.join(shared, "bucket")


def _torn(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, h, bytes, root, main, size, torn) of the members of buckets that lie in several components; `main` is the
    component with most members there, `torn` the number of the bucket's pairs from different components."""
    placed = buckets.filter("n > 2").select("bucket", "h", "bytes").join(roots.withColumnRenamed("node", "h"), "h", "left")
    placed = placed.withColumn("root", F.coalesce("root", "h"))
    parts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("m"))
    whole = parts.groupBy("bucket").agg(
        F.max_by("root", F.struct("m", "root")).alias("main"), F.sum("m").alias("size"), F.sum(F.col("m") * F.col("m")).alias("squares"))
    several = whole.filter(F.col("squares") < F.col("size") * F.col("size")).select(
        "bucket", "main", "size", ((F.col("size") * F.col("size") - F.col("squares")) / 2).alias("torn"))
    return placed.join(several, "bucket")


def _to_main(torn: DataFrame, turn: int) -> DataFrame:
    """Each member outside its bucket's main component with a few members of that component, others each turn.

    A text's picks from all its buckets are put together before they become pairs, so no comparison is made twice.
    """
    picks = [F.min_by("h", F.xxhash64("h", "bucket", F.lit(turn * PICKS + i))) for i in range(PICKS)]
    picked = torn.filter("root = main").groupBy("bucket").agg(F.array(*picks).alias("picks"))
    outside = torn.filter("root != main").select("bucket", "h", "bytes").join(picked, "bucket")
    together = outside.groupBy("h", "bytes").agg(F.array_distinct(F.flatten(F.collect_list("picks"))).alias("picks"))
    return together.select(F.col("h").alias("a"), F.explode("picks").alias("b"), "bytes")


def _across(torn: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs of a bucket that lie in different components and agree enough to be a link.

    One text of such a pair lies outside the main component. Those are dealt into chunks, all members into blocks, and
    every chunk meets every block.
    """
    outside = torn.filter("root != main")
    chunks = outside.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    known = torn.join(chunks, "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).join(sketches.select("h", "short", "plain"), "h")
    place = F.xxhash64("h")
    members = known.select(
        "bucket", F.pmod(place, F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "h", "root", "short", "plain")
    others = known.filter("root != main").select(
        F.col("bucket").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("of_block"),
        F.pmod(place, F.col("chunks")).alias("of_chunk"), F.col("main").alias("of_main"), *[F.col(c).alias(f"of_{c}") for c in ("h", "root", "short", "plain", "bytes")])

    def agreeing(all_: pa.Table, few: pa.Table) -> pa.Table:
        def read(table: pa.Table, *names: str) -> tuple[np.ndarray, ...]:
            *keys, short, plain = [table.column(c).to_pylist() for c in names]
            components = [b"".join(short), b"".join(s if p is None else p for s, p in zip(short, plain, strict=True))]
            return (
                *[np.array(x, object) for x in keys], *[np.frombuffer(x, "<u2").reshape(table.num_rows, SIZE) for x in components],
                np.array([p is not None for p in plain], bool))

        keys, roots, short, plain, repeats = read(all_, "h", "root", "short", "plain")
        own, own_roots, own_short, own_plain, own_repeats = read(few, "of_h", "of_root", "of_short", "of_plain")
        found_a, found_b, sizes = [], [], []
        if len(keys) and len(own):
            main = few.column("of_main")[0].as_py()
            for i, size in enumerate(few.column("of_bytes").to_pylist()):
                # Two texts that are both outside the main component meet twice; one time counts.
                near = np.flatnonzero(((roots == main) | (keys < own[i])) & (roots != own_roots[i]))
                agree = (short[near] == own_short[i]).mean(axis=1) >= LEAST_AGREEMENT
                again = np.flatnonzero(~agree & (repeats[near] | own_repeats[i]))
                agree[again] = (plain[near[again]] == own_plain[i]).mean(axis=1) >= LEAST_AGREEMENT
                near = near[agree]
                found_a += [own[i]] * len(near)
                found_b += keys[near].tolist()
                sizes += [size] * len(near)
        return pa.table({"a": pa.array(found_a, pa.binary()), "b": pa.array(found_b, pa.binary()), "bytes": pa.array(sizes, pa.int32())})

    meet = members.groupBy("bucket", "block", "chunk").cogroup(others.groupBy("of", "of_block", "of_chunk"))
    return meet.applyInArrow(agreeing, "a binary, b binary, bytes int").distinct()


def _roots(links: DataFrame, texts: DataFrame, buckets: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Components of the verified links, and of all links between components that share a bucket.

    As long as the pairs from different components are many against the members, members outside a bucket's main
    component are compared with single members of it, which brings most of them in; the rest is compared in full.
    """
    roots = connected_components(links)
    for turn in range(TURNS + 1):
        torn = materialize(_torn(buckets, roots), "torn")
        members, pairs = torn.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("torn") / F.col("size")), F.lit(0.0))).first()
        if not members:
            break
        full = turn == TURNS or pairs <= FEW_PAIRS * members
        more = materialize(_across(torn, sketches) if full else _to_main(torn, turn), "across")
        more = materialize(_verified(more, texts, threshold), "verified")
        if not more.isEmpty():
            roots = connected_components(roots.toDF("a", "b").unionByName(more))
        if full:
            break
    return roots


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(h, first, class_id, leads, texts, rows) of every text that has a duplicate: its key, the smallest document with
    it, the smallest document of its class, whether it is that document's text, and the class's numbers of different
    texts and of rows."""
    plain = docs.select(column(key).alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    keyed = plain.withColumn("h", text_key(F.col("text")))
    copies = materialize(keyed.select("h", "doc_id").groupBy("h").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "copies")
    sketched = keyed.select("h", F.octet_length("text").alias("bytes"), _sketch(F.col("text")).alias("sketch")).select(
        "h", "bytes", "sketch.*").dropDuplicates(["h"])
    sketches = materialize(sketched, "sketches")
    buckets = materialize(_buckets(sketches), "buckets")
    pairs = materialize(buckets.filter("h != rep").select(F.col("h").alias("a"), F.col("rep").alias("b"), "bytes").distinct(), "pairs")
    near = buckets.select("h").distinct()
    texts = materialize(keyed.select("h", "text").dropDuplicates(["h"]).join(near, "h", "left_semi"), "texts")
    links = materialize(_verified(pairs, texts, threshold), "verified")
    roots = _roots(links, texts, buckets, sketches, threshold)
    placed = copies.join(roots.withColumnRenamed("node", "h"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    lead = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "h"))
    whole = placed.groupBy("root").agg(lead.alias("lead"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("rows"))
    named = placed.join(whole.filter("rows > 1"), "root").select(
        "h", "first", F.col("lead.first").alias("class_id"), (F.col("h") == F.col("lead.h")).alias("leads"), "texts", "rows")
    return materialize(named, "classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_texts, class_rows."""
    found = classes(docs, key, text, threshold)
    rows = docs.select(column(key).alias("doc_id"), text_key(column(text)).alias("h"))
    joined = lookup_join(rows, found, ["h"], ["doc_id"], fits_in_memory(found), "left")
    return joined.select(
        "doc_id", F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("texts", F.lit(1)).cast("long").alias("class_texts"), F.coalesce("rows", F.lit(1)).cast("long").alias("class_rows"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest key. Of rows with equal key and text,
    one is kept too."""
    found = classes(docs, key, text, threshold).select("h", F.col("first").alias("stays"), F.col("leads").alias("best"))
    rows = packed(docs, column(key).alias("id"), text_key(column(text)).alias("h"))
    kept = lookup_join(rows, found, ["h"], ["id"], fits_in_memory(found), "left").filter(
        F.col("best").isNull() | (F.col("best") & F.col("id").eqNullSafe(F.col("stays"))))
    twice = kept.filter("best").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        alone = kept.filter("best IS NULL").select("row")
        kept = alone.unionByName(kept.filter("best").groupBy("h").agg(F.min("row").alias("row")).select("row"))
    return kept.select("row.*")

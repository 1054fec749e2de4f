import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankweave.functions import text
from rankweave.functions.stemming import stem, stem_vocabulary

# Published example words of the algorithm.
PUBLISHED = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "generalizations": "gener", "oscillators": "oscil", "is": "is",
}


@pytest.mark.parametrize("word", PUBLISHED)
def test_published_stems(word):
    assert stem(word) == PUBLISHED[word]


@given(st.text(alphabet="abcdefghijklmnopqrstuvwxyz", min_size=1, max_size=12))
@settings(max_examples=300, deadline=None)
def test_stem_never_grows_by_more_than_one(word):
    assert len(stem(word)) <= len(word) + 1


def test_analysis(spark):
    rows = spark.createDataFrame(
        [(1, "The CAT's 3.14 a_b ..x.y. I and cats"), (2, None), (3, ""), (4, "Running runs to the Élan")],
        "id int, t string")
    plain = {r[0]: r[1] for r in rows.select("id", text.analyze(F.col("t"))).collect()}
    assert plain == {1: ["cat", "3.14", "a_b", "x.y", "cats"], 2: [], 3: [], 4: ["running", "runs", "élan"]}
    stemmed = {r[0]: r[1] for r in rows.select("id", text.analyze(F.col("t"), stem=True)).collect()}
    assert stemmed == {1: ["cat", "3.14", "a_b", "x.y", "cat"], 2: [], 3: [], 4: ["run", "run", "élan"]}


def test_long_dotted_text_does_not_recurse(spark):
    long = ".".join(["1"] * 50_000) + " end"
    assert spark.createDataFrame([(long,)], "t string").select(F.size(text.analyze(F.col("t")))).first()[0] == 2


def test_vocabulary_stems(spark):
    terms = spark.createDataFrame([("cats",), ("cat",), ("cats",)], "term string")
    assert sorted(tuple(r) for r in stem_vocabulary(terms).collect()) == [("cat", "cat"), ("cats", "cat")]


def test_url_helpers(spark):
    row = spark.createDataFrame([("http://a.b/c/d",)], "url string").select(
        text.url_text(F.col("url")), text.slash_count(F.col("url"))).first()
    assert tuple(row) == ("http://a b/c/d", 4)

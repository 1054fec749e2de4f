"""Fill-in-middle texts, with Spark's own functions only.

A text is cut into units (a word with the blanks before it, or blanks at the end) and its parts are put in the order
suffix, prefix, middle (`spm`) or prefix, suffix, middle (`psm`), each behind a marker. One regular expression per row
takes the three parts in a single match: two groups of units, counted exactly and possessive, so the match never
turns back and its cost is linear in the text, and the rest. Which texts change and where they are cut follows from a
hash of seed and key alone, so a job that runs again makes the same texts.

Rows: a null text is empty; a null key is drawn like an empty one. Empty texts and texts that hold a marker stay plain.
Rows with equal keys are drawn alike. Whole texts are read, however long. Other columns stay as they are, but for those
that have the name of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm.common import column, packed, with_result

# What a unit is, and the markers before prefix, suffix and middle.
BLANK = r"[\x20\x09-\x0D]"
OTHER = r"[^\x20\x09-\x0D]"
UNIT = f"(?:{BLANK}*+{OTHER}++|{BLANK}++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
ORDERS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
PLAIN = "plain"

SEED = 42
RATE = 50
SPM_RATE = 80
RESULT = ["n", "form", "prefix_chars", "middle_chars", "output"]


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE,
              spm_rate: int = SPM_RATE) -> DataFrame:
    """The columns of `docs` and n (units), form, prefix_chars, middle_chars (null if plain) and output.

    Of 100 texts `rate` change, of 100 that change `spm_rate` take the order suffix, prefix, middle.
    """
    rows = packed(
        docs, F.coalesce(column(text), F.lit("")).alias("whole"), F.array(*draws(column(key), seed)).alias("h"))
    counted = rows.withColumn("n", F.regexp_count("whole", F.lit(UNIT)).cast("long"))
    h = [F.col("h")[i] for i in range(4)]
    one, two = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    plain = (F.col("whole") == "") | F.col("whole").rlike(MARKER) | (h[2] % 100 >= rate)
    form = F.when(plain, PLAIN).when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    cut = counted.select(
        "row", "whole", "n", form.alias("form"), F.least(one, two).alias("a"), F.abs(one - two).alias("more"))
    pattern = F.concat(
        F.lit(rf"(?s)\A({UNIT}{{"), F.col("a"), F.lit(rf"}}+)({UNIT}{{"), F.col("more"), F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("form") == "spm", ORDERS["spm"]).otherwise(ORDERS["psm"])
    output = F.when(F.col("form") == PLAIN, F.col("whole")).otherwise(F.regexp_replace(F.col("whole"), pattern, order))
    made = cut.select("row", "n", "form", output.alias("output"))
    told = made.withColumn("parts", parts(F.col("output"), F.col("form")))
    chars = {name: F.char_length(F.col("parts")[name]).cast("long") for name in ("prefix", "middle")}
    return told.select(
        *with_result(docs, RESULT), "n", "form", chars["prefix"].alias("prefix_chars"),
        chars["middle"].alias("middle_chars"), "output")


def parts(output: Column, form: Column) -> Column:
    """struct<prefix, middle, suffix> of an output; null if it is plain.

    A text with a marker in it stays plain, and no marker can begin inside another, so the markers found are those
    that were put there.
    """
    pieces = F.split(output, MARKER, 4)

    def at(psm: int, spm: int) -> Column:
        return F.when(form == "spm", pieces[spm]).otherwise(pieces[psm])

    whole = F.struct(at(1, 2).alias("prefix"), pieces[3].alias("middle"), at(2, 1).alias("suffix"))
    return F.when(form != PLAIN, whole)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    of = parts(output, form)
    return F.when(form == PLAIN, output).otherwise(F.concat(of["prefix"], of["middle"], of["suffix"]))

"""Small tables with every awkward case, and plain-Python versions of shared notions."""

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")

PROSE = ("the cat sat on the mat and looked at the moon while rain fell on the old stone roof of the house near the river "
         "where boats lay still under heavy grey clouds that slowly moved to the east").split()


def words(text):
    return WORD.findall(text or "")


def awkward(spark, extra=()):
    """Nulls in every column, empty and white texts, repeated rows, ties, a very long text."""
    base = " ".join(PROSE)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base.upper(), "en", "b", 1),
        (4, " ".join(PROSE[:-1] + ["west"]), "en", None, None), (5, None, "en", "a", 0), (6, "", "en", "b", 0),
        (7, " \t\n\x0b\x0c\r ", None, "b", 3), (8, "one two three", "en", "c", 13), (9, "one two three", "en", "c", 13),
        (10, "123 456 --- 789", "en", "c", 15), (11, "é\x1cñ ß 日本 😀 x\x85y", "fr", "c", 5),
        (12, "\n".join(["same line here"] * 6 + [base]), "en", "c", 1), (13, (base + " ") * 400, "en", "a", 1),
        (14, " ".join(f"w{i}" for i in range(12000)), "en", "zz", 1), (None, "no id at all but some words here", "en", "a", 1),
        (None, base, "en", "a", 1), (8, "one two three", "en", "c", 13), (15, "### $$$ ***&&& |||", "en", "c", 9),
        *extra]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("id", "key", "size", "shard", "slot", "n", "comp", "rep", "block", "h", "c", "words", "start", "length",
             "rng", "guest", "held", "ids", "part", "score", "kept", "target", "taken", "src", "name", "file", "times", "_lang",
             "_node", "node", "row", "lead", "_m", "_fail_mask", "_mix_same", "_mix_text", "_mix_part", "_mix_row", "_mix_span", "_mix_nth")
    return docs.select("*", *[F.lit(f"x-{n}").alias(n) for n in names])


def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, key="doc_id"):
    return sorted((tuple(r) for r in df.collect()), key=repr)

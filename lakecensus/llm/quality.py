"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document: its failure is one bit of ``fail_mask``, next to the
measurements it read. A policy is a version name and a set of rules, so a verdict is one bitwise
AND, and new policies or ablations never read a text again.

Defined cases: null and empty texts have no words (and fail ``few_words`` alone); a rule whose
measure is undefined passes; repeated rows are judged alike; an empty table gives no rows; other
columns of the input are kept by ``ledger`` and never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.llm.common import SPACES, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# rule -> failure over the measurements; the position is the rule's bit
RULES: dict[str, Callable[[Column], Column]] = {
    "few_words": lambda m: m["n_words"] < 10,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 12 * m["n_words"]),
    "upper_case": lambda m: 10 * m["n_upper"] > 4 * m["word_chars"],
}
# versioned policies: a document is kept if none of these rules fails
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "clean-1": tuple(RULES),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once: a lambda over an array of one. Named columns
    would be copied into every use when Spark moves a filter below them."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(windows: Column) -> Column:
    """Words inside windows found twice or more. Sorted by hash, equal windows are neighbours;
    their starts, sorted, cover min(WINDOW, distance to the start before) new words each."""
    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        def start(x: Column, j: Column) -> Column:
            same = (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
            return F.when(F.coalesce(same, F.lit(False)), x["i"])

        return F.array_sort(F.array_compact(F.transform(s, start)))

    covered = F.aggregate(
        let(order, starts), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)


def measures(text: Column) -> Column:
    """The measurements of a text as one struct."""

    def windows(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return F.when(F.size(h) >= WINDOW, each).otherwise(F.array().cast("array<bigint>"))

    def gather(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        hashes = F.transform(words(t), lambda w: F.xxhash64(w))
        return let(hashes, lambda h: let(F.translate(t, SPACES, ""), lambda bare: let(lines, lambda ls: F.struct(*[
            value.cast("long").alias(name) for name, value in {
                "n_words": F.size(h),
                "word_chars": F.char_length(bare),
                "n_symbols": F.char_length(bare) - F.char_length(F.translate(bare, SYMBOLS, "")),
                "n_lines": F.size(ls),
                "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
                "n_repeat_words": let(windows(h), repeated_words),
                "n_upper": F.char_length(bare) - F.char_length(F.translate(bare, UPPER, "")),
            }.items()]))))

    return gather(F.coalesce(text, F.lit("")))


def fail_mask(m: Column) -> Column:
    """One bit per failing rule, from the struct of measurements."""
    mask = F.lit(0).cast("long")
    for rule, fails in RULES.items():
        mask = mask.bitwiseOR(F.when(fails(m), F.lit(bit(rule))).otherwise(F.lit(0)).cast("long"))
    return mask


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the struct ``_m`` of measurements and ``_fail_mask``; columns of the caller's
    that have these two names are replaced, all others are kept."""
    return docs.withColumn("_m", measures(F.col(text))).withColumn("_fail_mask", fail_mask(F.col("_m")))


def passes(mask: Column, policy: str) -> Column:
    return mask.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (kept if it were dropped),
    and that the policy rejects. Masks are counted once; all else is bitwise work on the counts."""
    mask = F.lit(policy_mask(policy)).cast("long")
    counts = book.groupBy(F.col("_fail_mask").bitwiseAND(mask).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    each = counts.select("mask", "n", F.explode(rules).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("fails_alone"),
        F.sum(F.when(F.col("mask") != 0, F.col("n")).otherwise(0)).alias("rejected"))


def kept_documents(docs: DataFrame, policy: str = "clean-1") -> DataFrame:
    """The documents that pass a policy, with their own columns."""
    return docs.where(let(measures(F.col("text")), lambda m: passes(fail_mask(m), policy)))

"""Language identification by a string kernel.

Kernel: blended-spectrum presence kernel, the number of letter n-grams (n = 1 .. 4, lower case,
runs of anything else are one blank) that two texts share, over the root of the product of their
own numbers. N-grams are hashed into DIM bits, so a text of any length is a presence row.
Fit: Nyström features against landmark texts and one-versus-rest kernel ridge regression, on a
sample of labelled rows of at most ``max_rows`` (documented bound; spread evenly over languages,
chosen by a hash of the key) of which ``landmarks`` serve as landmarks.
Scoring: a batch's presence rows times one DIM x languages matrix (landmarks, Nyström root and
ridge weights multiplied out), over whole texts.
Acceptance: a text in a language or script that wasn't learned still has a best language, with a
small lead. A text is accepted if its score reaches a bar that rises with its distinct n-grams,
from 0.5 (a tie) to MIN_SCORE at SURE of them, and at least MIN_KNOWN of its letters occur in the
sample. Texts of a few words have small leads in any language, so that for them it is mostly the
letters that decide.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a null label is
not learned; without any labelled row everything is ``und``; ties go to the first language by
code point; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

DIM = 1 << 15
GRAMS = (1, 2, 3, 4)
MAX_ROWS = 2000
LANDMARKS = 256
RIDGE = 1e-3
UNKNOWN = "und"
TIE = 0.5  # the score of a tie between two languages
MIN_SCORE = 0.7  # the score asked of a text of SURE distinct n-grams or more
SURE = 500  # some fifty words
MIN_KNOWN = 0.5  # share of a text's letters that the sample has
_CHUNK = 128  # presence rows multiplied at a time
_SPAN = 1 << 18  # code points whose n-grams are hashed at a time


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


def _lettered(text: str) -> np.ndarray:
    """The letters of a text in lower case, in order."""
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    return c[c != 32]


def _mark(flags: np.ndarray, c: np.ndarray, doc: np.ndarray, starts: int) -> None:
    """Set the bits of the n-grams that begin at the first ``starts`` places."""
    row = doc.astype(np.int64) * DIM
    code = np.zeros(len(c), dtype=np.uint32)
    for g in range(1, max(GRAMS) + 1):
        m = len(c) - g + 1
        if m <= 0:
            break
        code = code[:m] * np.uint32(0x9E3779B1) + c[g - 1:] + np.uint32(g)
        if g not in GRAMS:
            continue
        inside = doc[:m] == doc[g - 1:]
        inside[starts:] = False
        if g == 1:
            inside &= c[:m] != 32
        mixed = code ^ (code >> np.uint32(15))
        mixed *= np.uint32(0x85EBCA6B)
        flags[(row[:m] + (mixed >> np.uint32(17)))[inside]] = 1


def presence(texts: list[str]) -> np.ndarray:
    """One row of DIM presence flags per text; no flag is set for a text without letters."""
    n = len(texts)
    flags = np.zeros(n * DIM, dtype=np.uint8)
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = _letters()[raw]
    doc = np.repeat(np.arange(n, dtype=np.int32), lens)
    blank = c == 32
    keep = np.ones(len(c), dtype=bool)  # a run of blanks is one blank
    keep[1:] = ~(blank[1:] & blank[:-1] & (doc[1:] == doc[:-1]))
    c, doc = c[keep], doc[keep]
    for at in range(0, len(c), _SPAN):  # n-grams that begin in this span
        _mark(flags, c[at:at + _SPAN + max(GRAMS) - 1], doc[at:at + _SPAN + max(GRAMS) - 1], min(_SPAN, len(c) - at))
    lettered = np.zeros(n, dtype=bool)
    lettered[doc[c != 32]] = True
    flags = flags.reshape(n, DIM)
    flags[~lettered] = 0
    return flags


def _products(flags: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Presence rows, scaled to length 1, times a matrix of DIM rows."""
    out = np.empty((len(flags), right.shape[1]), dtype=np.float32)
    for i in range(0, len(flags), _CHUNK):
        part = flags[i:i + _CHUNK]
        size = np.sqrt(np.maximum(part.sum(axis=1, dtype=np.int64), 1)).astype(np.float32)
        out[i:i + _CHUNK] = (part.astype(np.float32) @ right) / size[:, None]
    return out


def _known(texts: list[str], letters: np.ndarray) -> np.ndarray:
    """Share of each text's letters that are in ``letters`` (a flag per code point); 0 without a letter."""
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        had = total = 0
        for at in range(0, len(t), _SPAN):
            c = _lettered(t[at:at + _SPAN])
            had, total = had + int(letters[c].sum()), total + len(c)
        out[i] = had / max(total, 1)
    return out


def fit(flags: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """(languages, DIM x languages matrix) from presence rows and their labels."""
    names = sorted(set(labels))
    marks = flags[:landmarks]
    size = np.sqrt(np.maximum(marks.sum(axis=1, dtype=np.int64), 1))
    unit = np.ascontiguousarray((marks / size[:, None]).astype(np.float32).T)  # DIM x landmarks
    values, vectors = np.linalg.eigh(_products(marks, unit).astype(np.float64))
    good = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, good] / np.sqrt(values[good])  # landmark kernel to the power -1/2, by its parts
    phi = _products(flags, unit).astype(np.float64) @ root
    aims = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weights = np.linalg.solve(phi.T @ phi + ridge * len(labels) * np.eye(phi.shape[1]), phi.T @ aims)
    return names, np.ascontiguousarray((unit.astype(np.float64) @ root @ weights).astype(np.float32))


def decide(scores: np.ndarray, names: list[str], known: np.ndarray) -> pd.DataFrame:
    """Best language and (1 + lead over the second best) / 2, within 0 and 1."""
    best = scores.argmax(axis=1)
    top = scores[np.arange(len(scores)), best]
    rest = scores.copy()
    rest[np.arange(len(scores)), best] = -np.inf
    second = rest.max(axis=1) if scores.shape[1] > 1 else np.zeros(len(scores))
    lead = np.clip((1 + top - second) / 2, 0, 1)
    return pd.DataFrame({"lang": np.where(known, np.array(names, dtype=object)[best], UNKNOWN),
                         "score": np.where(known, lead, 0.0).astype(np.float64)})


def sample(docs: DataFrame, may_learn: Column, key: str, text: str, lang: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled rows, evenly over languages, by a hash of key and text."""
    rows = docs.where(may_learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.lit(0).cast("long").alias("h")).limit(0)
    quota = max(1, max_rows // len(counts))
    unit = F.shiftrightunsigned(F.col("h"), 11) / float(1 << 53)
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, min(1.0, (2.0 * quota + 50) / n)).otherwise(share)
    few = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.lit(5)).alias("h")) \
        .where(unit < share)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", F.xxhash64("text")))
    return few.withColumn("nth", nth).where(F.col("nth") <= quota)


def train(docs: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
          max_rows: int = MAX_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """(languages, matrix, flags of the letters that occur), fitted on a bounded sample: presence
    rows (DIM / 8 bytes each) and distinct letters come to the driver, no texts."""

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            packed = np.packbits(presence(b["text"].tolist()), axis=1)
            yield pd.DataFrame({"lang": b["lang"], "nth": b["nth"], "bits": [x.tobytes() for x in packed],
                                "letters": [np.unique(_lettered(t)).astype("<u4").tobytes() for t in b["text"]]})

    rows = sample(docs, may_learn, key, text, lang, max_rows)
    if "nth" not in rows.columns:
        return None
    got = rows.select("lang", "text", "nth").mapInPandas(
        bits, "lang string, nth int, bits binary, letters binary").collect()
    got.sort(key=lambda r: (r["nth"], r["lang"]))  # landmarks: the first of every language in turn
    if not got:
        return None
    flags = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in got]), axis=1)
    letters = np.zeros(0x110000, dtype=bool)
    for r in got:
        letters[np.frombuffer(r["letters"], "<u4")] = True
    return *fit(flags, [r["lang"] for r in got], landmarks, ridge), letters


def predict(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """The input and the struct ``_lang`` of (lang, score, distinct n-grams, share of known letters)."""
    if model is None:
        return docs.withColumn("_lang", F.struct(
            F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("grams"),
            F.lit(0.0).alias("known")))
    held = docs.sparkSession.sparkContext.broadcast(model)  # DIM floats per language, a flag per code point

    @F.pandas_udf("lang string, score double, grams long, known double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, matrix, letters = held.value
        for texts in batches:
            texts = [t or "" for t in texts]
            flags = presence(texts)
            grams = flags.sum(axis=1, dtype=np.int64)
            yield decide(_products(flags, matrix), names, grams > 0).assign(grams=grams, known=_known(texts, letters))

    return docs.withColumn("_lang", score(F.col(text)))


def may_learn(key: str = "doc_id") -> Column:
    """Rows outside the held-out fold: crc32 of the key as text, mod 4, isn't 2."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 != 2


def accepted_documents(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents in a language that the labelled ones teach, with their own columns."""
    # the row travels as one value, so that no column of the caller's can be taken for one made here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = predict(rows, train(docs, may_learn()), "row.text")
    bar = TIE + (min_score - TIE) * F.least(F.lit(1.0), F.col("_lang.grams") / SURE)
    return kept.where((F.col("_lang.lang") != UNKNOWN) & (F.col("_lang.score") >= bar)
                      & (F.col("_lang.known") >= MIN_KNOWN)).select("row.*")

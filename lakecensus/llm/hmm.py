"""Language-model scoring by a hidden Markov model over words.

Emissions: a state's probability of word w is lift[state, class(w)] times w's add-one unigram
probability (c + 1) / (N + V + 1). The OWN most frequent words have a class each, the end token
has one, other words share SUFFIXES classes by their last three bytes, and words that training
never saw are one class whose lift is 1. For every state the lifts, weighted by the classes'
unigram probabilities, sum to 1, so the model is a distribution over the V known words and the
unknown one; with a single state it is the unigram base itself.

Training: Baum-Welch over all training sequences. Every partition adds up its expected counts
and sends one row per class; these are summed by class, and the bounded result (classes x states)
updates the model on the driver. Long texts are cut into segments of STEP tokens whose transfer
matrices are multiplied in parallel and chained per text, so forward and backward values are
those of the whole text. Scaling keeps them in range; the logarithms of the scales are the
sequence's exact likelihood.

Steps: one pass over the texts turns them into blocks of about BLOCK tokens (local word numbers,
word hashes, training counts). Counts are summed by word hash, joined back to every block's
distinct words (not to its tokens), and each block becomes class sequences, staged once and read
by all later passes. Words are told apart by a 64-bit hash.

Defined cases: null and empty texts are one end token; without training rows every count is 0,
the states' lifts stay 1 and score equals base_score; repeated rows count as often as they occur;
a null id is a key like any other; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.llm.common import staged
from lakecensus.llm.minhash import word_list

STATES = 6
TOLERANCE = 0.02  # training ends when a round gains less log10 likelihood a token than this
MOST_ROUNDS = 30  # a stop that is reported when it is hit
OWN, SUFFIXES = 16384, 4096
QUANTILE = 100_000  # the rank of a quantile is right within a share of 1 / QUANTILE
END, UNKNOWN = OWN + SUFFIXES, OWN + SUFFIXES + 1
CLASSES = OWN + SUFFIXES + 2
BLOCK = 1 << 21  # tokens of a block
BATCH = 1 << 17  # tokens whose recursions run together
STEP = 128
RESCALE = 8
STAY = 0.9  # first guess of a state's chance to go on
PRIOR = 1000.0  # pseudo-tokens of the unigram model that each state's emissions start from
SEED = 8


# ---- texts to blocks ---------------------------------------------------------------------------

def blocks_of(docs: DataFrame, held: Column, key: str, text: str) -> DataFrame:
    """One row per block: ids, held flags and lengths of its texts, local word numbers, and per
    distinct word its hash, training count and suffix class."""

    def block(number: int, ids, flags, lens, at, words) -> pd.DataFrame:
        at, lens, flags = np.concatenate(at), np.array(lens, dtype=np.int64), np.array(flags, dtype=bool)
        # frequent words get small numbers, kept as a low and a high part: these compress well
        order = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        at, distinct = rank[at], np.array(list(words), dtype=object)[order]
        counts = np.bincount(at[np.repeat(~flags, lens)], minlength=len(distinct))
        hashes = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.zeros(0, np.uint64)
        suffix = np.array([zlib.crc32(w[-3:]) % SUFFIXES for w in distinct], dtype="<u2")
        return pd.DataFrame({
            "block": [number], "ids": [list(ids)], "held": [flags.tobytes()],
            "lens": [lens.astype("<i4").tobytes()], "words": [len(distinct)],
            "low": [(at & 0xFFFF).astype("<u2").tobytes()], "high": [(at >> 16).astype("<u2").tobytes()],
            "hashes": [hashes.view(np.int64).astype("<i8").tobytes()], "counts": [counts.astype("<i4").tobytes()],
            "suffixes": [suffix.tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 24
        ids, flags, lens, at, words, size = [], [], [], [], {}, 0
        for b in batches:
            lists = [word_list(t) for t in b["text"]]
            flat = np.empty(sum(map(len, lists)), dtype=object)
            flat[:] = [w for t in lists for w in t]
            mine, distinct = pd.factorize(flat) if len(flat) else (np.zeros(0, np.int64), [])
            numbers = np.array([words.setdefault(w, len(words)) for w in distinct], dtype=np.int64)
            at.append(numbers[mine].astype(np.int32))
            ids.extend(b["id"])
            flags.extend(b["held"])
            lens.extend(map(len, lists))
            size += len(flat)
            if size >= BLOCK:
                yield block(number, ids, flags, lens, at, words)
                number, ids, flags, lens, at, words, size = number + 1, [], [], [], [], {}, 0
        if ids:
            yield block(number, ids, flags, lens, at, words)

    rows = docs.select(F.col(key).cast("string").alias("id"), held.alias("held"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "block long, ids array<string>, held binary, lens binary, words int, low binary, "
                                 "high binary, hashes binary, counts binary, suffixes binary")


def _words(blocks: DataFrame, trained_only: bool) -> DataFrame:
    """(block, i, h, c, suffix): the distinct words of every block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for number, h, c, s in zip(b["block"], b["hashes"], b["counts"], b["suffixes"]):
                out = pd.DataFrame({"block": number, "h": np.frombuffer(h, "<i8"),
                                    "c": np.frombuffer(c, "<i4").astype(np.int64),
                                    "suffix": np.frombuffer(s, "<u2").astype(np.int32)})
                out.insert(1, "i", np.arange(len(out), dtype=np.int32))
                yield out[out["c"] > 0] if trained_only else out

    return blocks.select("block", "hashes", "counts", "suffixes").mapInPandas(
        run, "block long, i int, h long, c long, suffix int")


def _trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"n": [sum(int((~np.frombuffer(h, bool)).sum()) for h in b["held"])]})


def sequences(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text"):
    """(block rows of class sequences and unigram scores, facts of the training tokens)."""
    spark = docs.sparkSession
    blocks = staged(blocks_of(docs, held, key, text), "blocks")
    counts = staged(_words(blocks, True).groupBy("h").agg(F.sum("c").alias("c"), F.min("suffix").alias("suffix")), "counts")
    ends = blocks.select("held").mapInPandas(_trained, "n long").agg(F.sum("n")).first()[0] or 0
    total, kinds = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    tokens, types = (total or 0) + ends, kinds + (1 if ends else 0)

    # every task sends its own largest to the driver, so only words above a count that somewhat more
    # than OWN words reach (an approximate quantile, its error allowed for) are sorted at all
    often, share = counts, (2 * OWN + 2 * kinds / QUANTILE) / max(1, kinds)
    if share < 1:
        least = counts.agg(F.percentile_approx("c", 1 - share, QUANTILE)).first()[0]
        often = counts.where(F.col("c") >= least)
    top = often.orderBy(F.desc("c"), "h").limit(OWN).select("h").collect()  # at most OWN rows
    own = spark.createDataFrame([(r["h"], i) for i, r in enumerate(top)], "h long, own int")
    classed = counts.join(F.broadcast(own), "h", "left").select(
        "h", "c", F.coalesce("own", F.col("suffix") + OWN).alias("cls"))
    mass = np.zeros(CLASSES)
    for r in classed.groupBy("cls").agg(F.sum(F.col("c") + 1).alias("m")).collect():  # at most CLASSES rows
        mass[r["cls"]] = r["m"]
    mass[END], mass[UNKNOWN] = (ends + 1 if ends else 0), 1
    facts = {"tokens": int(tokens), "types": int(types), "ends": int(ends), "unigram": mass / mass.sum()}
    every = float(tokens + types + 1)

    def assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame()
        row = left.iloc[0]
        at = np.frombuffer(row["high"], "<u2").astype(np.int64) << 16 | np.frombuffer(row["low"], "<u2")
        lens, size = np.frombuffer(row["lens"], "<i4").astype(np.int64), int(row["words"])
        c, cls = np.zeros(size, np.int64), np.full(size, UNKNOWN, np.int64)
        c[right["i"].to_numpy()], cls[right["i"].to_numpy()] = right["c"].to_numpy(), right["cls"].to_numpy()
        doc = np.repeat(np.arange(len(lens)), lens)
        known = np.bincount(doc, weights=(c > 0)[at], minlength=len(lens)) + (ends > 0)
        base = np.bincount(doc, weights=np.log10(c + 1.0)[at], minlength=len(lens)) + np.log10(ends + 1.0)
        base -= (lens + 1) * np.log10(every)
        out = np.full(len(at) + len(lens), END if ends else UNKNOWN, dtype="<u2")  # an end after every text
        out[np.arange(len(at)) + doc] = cls[at]
        return pd.DataFrame({
            "ids": [row["ids"]], "held": [row["held"]], "lens": [(lens + 1).astype("<i4").tobytes()],
            "classes": [out.tobytes()], "known": [known.astype("<i8").tobytes()], "base": [base.astype("<f8").tobytes()]})

    looked = _words(blocks, False).select("block", "i", "h").join(classed, "h").select("block", "i", "c", "cls")
    # dealt by the number of blocks: a task holds one or a few of them, however large the input
    n = max(1, blocks.count())
    whole = blocks.select("block", "ids", "held", "lens", "words", "low", "high").repartition(n, "block")
    rows = whole.groupBy("block").cogroup(looked.repartition(n, "block").groupBy("block")) \
        .applyInPandas(assemble, "ids array<string>, held binary, lens binary, classes binary, known binary, base binary")
    return staged(rows, "sequences"), facts


# ---- the model ---------------------------------------------------------------------------------

def first_guess(unigram: np.ndarray, states: int = STATES) -> dict:
    """Lifts around 1 from a seeded generator, states that tend to go on."""
    rng = np.random.default_rng(SEED)
    lift = rng.uniform(0.5, 1.5, (CLASSES, states))
    lift[UNKNOWN] = 1.0
    return {"start": np.full(states, 1 / states), "lift": _normal(lift, unigram),
            "move": np.full((states, states), (1 - STAY) / max(1, states - 1)) * (1 - np.eye(states))
            + np.eye(states) * (STAY if states > 1 else 1.0)}


def _normal(lift: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """Lifts with sum(unigram * lift) = 1 in every state, that of the unknown word being 1."""
    known = np.arange(CLASSES) != UNKNOWN
    out = lift.copy()
    share = (unigram[known, None] * lift[known]).sum(axis=0)
    out[known] *= (1 - unigram[UNKNOWN]) / np.where(share > 0, share, 1)
    return out


class Segments:
    """The texts of a block cut into runs of at most STEP tokens, longest first."""

    def __init__(self, classes: np.ndarray, lens: np.ndarray):
        per = -(-lens // STEP)
        self.doc = np.repeat(np.arange(len(lens)), per)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(per) - per, per)
        starts = (np.cumsum(lens) - lens)[self.doc] + nth * STEP
        size = np.minimum(lens[self.doc] - nth * STEP, STEP)
        order = np.argsort(-size, kind="stable")
        self.place = np.empty_like(order)
        self.place[order] = np.arange(len(order))  # segment in text order -> its row
        self.first = np.cumsum(per) - per  # text -> its first segment, in text order
        self.per, self.starts, self.size, self.classes = per, starts[order], size[order], classes
        self.active = [int(np.searchsorted(-self.size, -t, side="left")) for t in range(STEP)]
        self.steps = int(self.size[0]) if len(order) else 0

    def at(self, t: int) -> np.ndarray:
        """Classes of token t of the segments that have one."""
        return self.classes[self.starts[:self.active[t]] + t]


def transfers(seg: Segments, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Per segment the product of its move-and-emit matrices, scaled, and the log of the scale."""
    k = len(model["start"])
    out = np.broadcast_to(np.eye(k), (len(seg.size), k, k)).copy()
    logs = np.zeros(len(seg.size))
    for t in range(seg.steps):
        m = seg.active[t]
        out[:m] = (out[:m].reshape(m * k, k) @ model["move"]).reshape(m, k, k) * model["lift"][seg.at(t)][:, None, :]
        if t % RESCALE == RESCALE - 1 or t == seg.steps - 1:
            scale = out[:m].max(axis=(1, 2))
            out[:m] /= scale[:, None, None]
            logs[:m] += np.log(scale)
    scale = out.max(axis=(1, 2))
    return out / scale[:, None, None], logs + np.log(scale)


def chained(seg: Segments, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(state vector before every segment, vector after it, log likelihood lift of every text)."""
    mats, logs = transfers(seg, model)
    n, k = len(seg.per), len(model["start"])
    before = np.empty((len(seg.size), k))
    now, total = np.tile(model["start"], (n, 1)), np.zeros(n)
    longest = int(seg.per.max()) if n else 0
    for i in range(longest):
        docs = np.flatnonzero(seg.per > i)
        rows = seg.place[seg.first[docs] + i]
        before[rows] = now[docs]
        new = np.einsum("nk,nkj->nj", now[docs], mats[rows])
        scale = new.sum(axis=1)
        now[docs] = new / scale[:, None]
        total[docs] += np.log(scale) + logs[rows]
    after = np.empty((len(seg.size), k))
    back = np.ones((n, k))
    for i in range(longest - 1, -1, -1):
        docs = np.flatnonzero(seg.per > i)
        rows = seg.place[seg.first[docs] + i]
        after[rows] = back[docs]
        new = np.einsum("nkj,nj->nk", mats[rows], back[docs])
        back[docs] = new / new.max(axis=1, keepdims=True)
    return before, after, total


def expected(seg: Segments, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts: (start, moves, emissions by class), and the log likelihood lift of all texts."""
    k = len(model["start"])
    before, beta, lift = chained(seg, model)
    alphas, alpha = [], before.copy()
    for t in range(seg.steps):
        m = seg.active[t]
        new = (alpha[:m] @ model["move"]) * model["lift"][seg.at(t)]
        alpha = new / new.sum(axis=1, keepdims=True)
        alphas.append(alpha)
    moves, weights, found = np.zeros((k, k)), [], []
    for t in range(seg.steps - 1, -1, -1):
        m = seg.active[t]
        cls, b = seg.at(t), beta[:m]
        gamma = alphas[t] * b
        weights.append(gamma / gamma.sum(axis=1, keepdims=True))
        found.append(cls)
        prev = before[:m] if t == 0 else alphas[t - 1][:m]
        ahead = model["lift"][cls] * b
        back = ahead @ model["move"].T
        norm = (prev * back).sum(axis=1, keepdims=True)
        moves += (prev / norm).T @ ahead
        beta[:m] = back / back.max(axis=1, keepdims=True)
    moves *= model["move"]
    cls, weight = np.concatenate(found), np.concatenate(weights)
    emit = np.stack([np.bincount(cls, weights=weight[:, s], minlength=CLASSES) for s in range(k)], axis=1)
    first = seg.place[seg.first]
    start = before[first] * beta[first]
    return (start / start.sum(axis=1, keepdims=True)).sum(axis=0), moves, emit, float(lift.sum())


def update(model: dict, start: np.ndarray, moves: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> dict:
    """The next model; emissions start from PRIOR pseudo-tokens of the unigram model."""
    smooth = emit + PRIOR * unigram[:, None]
    lift = np.ones_like(emit)
    known = (np.arange(CLASSES) != UNKNOWN) & (unigram > 0)
    lift[known] = smooth[known] / smooth[known].sum(axis=0) / unigram[known, None]
    return {"start": (start + 1) / (start + 1).sum(), "move": (moves + 1) / (moves + 1).sum(axis=1, keepdims=True),
            "lift": _normal(lift, unigram)}


def _sequences(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row.classes, "<u2").astype(np.int64), np.frombuffer(row.lens, "<i4").astype(np.int64),
            np.frombuffer(row.held, bool))


def _batches(classes: np.ndarray, lens: np.ndarray) -> Iterator[Segments]:
    """Runs of whole texts of about BATCH tokens, so that the recursions' arrays stay small."""
    ends = np.cumsum(lens)
    first = 0
    while first < len(lens):
        start = int(ends[first] - lens[first])
        last = max(first + 1, int(np.searchsorted(ends, start + BATCH, side="right")))
        yield Segments(classes[start:ends[last - 1]], lens[first:last])
        first = last


def baum_welch(rows: DataFrame, facts: dict, states: int = STATES, tolerance: float = TOLERANCE,
               most_rounds: int = MOST_ROUNDS) -> dict:
    """Train on the texts that aren't held out, until a round gains less than ``tolerance`` (log10 a
    token). ``gains`` of the result are the log10 likelihoods a token, over the unigram base, of the
    models before each round."""
    spark, unigram = rows.sparkSession, facts["unigram"]
    model = first_guess(unigram, states)
    if not facts["ends"]:
        return {**model, "lift": np.ones_like(model["lift"]), "gains": []}
    gains: list[float] = []
    for _ in range(most_rounds):
        held = spark.sparkContext.broadcast(model)  # CLASSES x STATES numbers

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            sums = None
            for b in batches:
                for row in b.itertuples():
                    classes, lens, out = _sequences(row)
                    for seg in _batches(classes[np.repeat(~out, lens)], lens[~out]):
                        start, moves, emit, lift = expected(seg, held.value)
                        got = np.vstack([emit, moves, start[None, :], np.full((1, states), lift)])
                        sums = got if sums is None else sums + got
            if sums is not None:  # one row per class, then the moves, the start and the likelihood
                yield pd.DataFrame({"row": np.arange(len(sums), dtype=np.int32),
                                    **{f"s{i}": sums[:, i] for i in range(sums.shape[1])}})

        names = [f"s{i}" for i in range(states)]
        parts = rows.select("classes", "lens", "held").mapInPandas(run, "row int, " + ", ".join(f"{n} double" for n in names))
        table = np.zeros((CLASSES + states + 2, states))
        for r in parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).collect():  # CLASSES + STATES + 2 rows
            table[r["row"]] = [r[n] for n in names]
        model = update(model, table[-2], table[CLASSES:CLASSES + states], table[:CLASSES], unigram)
        gains.append(float(table[-1, 0] / np.log(10) / facts["tokens"]))
        if len(gains) > 1 and gains[-1] - gains[-2] < tolerance:
            break
    else:
        warnings.warn(f"Baum-Welch stopped after {most_rounds} rounds, before a round gained less than {tolerance}", stacklevel=2)
    return {**model, "gains": gains}


def scored(rows: DataFrame, model: dict) -> DataFrame:
    """(id, held, n_tokens, n_known, base_score, score) of every text."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                classes, lens, out = _sequences(row)
                base = np.frombuffer(row.base, "<f8")
                lift = np.concatenate([chained(seg, held.value)[2] for seg in _batches(classes, lens)])
                yield pd.DataFrame({"id": list(row.ids), "held": out, "n_tokens": lens,
                                    "n_known": np.frombuffer(row.known, "<i8"), "base_score": base,
                                    "score": base + lift / np.log(10)})

    return rows.mapInPandas(run, "id string, held boolean, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", states: int = STATES,
          tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """Train on the rows that aren't ``held`` and score all."""
    rows, facts = sequences(docs, held, key, text)
    out = scored(rows, baum_welch(rows, facts, states, tolerance, most_rounds))
    return out.select(F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("held").alias("held_out"),
                      "n_tokens", "n_known", F.lit(facts["tokens"]).cast("long").alias("train_tokens"),
                      "base_score", "score")

"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

* Shingles: distinct runs of WORDS words (a shorter text is one shingle), as 64-bit hashes.
* Signature: the shingles' places in a universe of 2**20 are permuted once (sigma); coordinate k
  is the least value of a second permutation (pi), circularly shifted by k, over these places.
  Two permutations serve all COORDINATES. Low 16 bits are kept.
* Bands of ROWS coordinates over the first BANDS * ROWS: at a similarity of 0.75 a pair shares
  none with probability (1 - 0.75**4)**40, about 3e-7.
* Texts with equal word sequences are one node (their smallest id) before anything is compared,
  so that copies cost one row each.
* Links, without pairing a bucket's members all with all:
  1. star: every node against the most connected member of its buckets; a large group of near
     copies becomes one component, and members of one component need no further link;
  2. clusters: in buckets that still hold several components, members of different components
     whose signatures agree on MIN_EST (5.5 standard deviations below the threshold) or more of
     the coordinates are put in one cluster; a pair at 0.75 agrees on fewer with probability 6e-8,
     less than the bands' own;
  3. inside a cluster, pairs across components with such signatures are confirmed, the likeliest
     first, until every one is confirmed, refuted or already connected.
  A link is confirmed on the two full shingle sets: 100 * common >= 75 * union. Buckets and
  clusters are compared in tiles of blocks of about TILE members, so that no task holds a group;
  only links that connect something leave a tile.
* Components: alternating large-star and small-star steps over the links.

Everything between the steps is staged on the shared checkpoint folder; ids and links never
reach the driver. Defined cases: null and empty texts and texts without words have no shingle and
are linked with nothing; rows that share an id are one node; rows with a null id take part, are
never a component's name and have a null component unless an id is reachable; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecensus.llm.common import partitions, staged

WORDS = 5
BANDS, ROWS = 40, 4
COORDINATES = 256
UNIVERSE_BITS = 20
SEED = 11
NUMERATOR, DENOMINATOR = 75, 100
MIN_EST = 0.75 - 5.5 * (0.75 * 0.25 / COORDINATES) ** 0.5
TILE = 1024
BROADCAST_IDS = 1_000_000  # more ids than this are joined by a shuffle
NO_ID = 1 << 62  # rows without an id are numbered from here while they are linked
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_list(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    sigma = rng.permutation(1 << UNIVERSE_BITS).astype(np.int32)
    pi = rng.permutation(1 << UNIVERSE_BITS).astype(np.int32)
    circle = np.concatenate([pi, pi[:COORDINATES]])
    return sigma, np.lib.stride_tricks.sliding_window_view(circle, COORDINATES)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each list of words."""
    counts = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.empty(int(counts.sum()), dtype=object)
    flat[:] = [w for t in texts for w in t]
    one = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, dtype=np.uint64)
    h = np.zeros(max(0, len(one) - WORDS + 1), dtype=np.uint64)
    for k in range(WORDS):
        h = h * _STEP + one[k:k + len(h)]
    h = _mixed(h)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(h[at:at + n - WORDS + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for x in one[at:at + n]:
                    whole = whole * _STEP + x
            out.append(_mixed(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def _linked(s: np.ndarray, t: np.ndarray) -> bool:
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both > 0 and DENOMINATOR * both >= NUMERATOR * (len(s) + len(t) - both)


@lru_cache(maxsize=4)
def recent_shingles(text: str) -> np.ndarray:
    """A text's shingle hashes, remembered: a centre's pairs follow each other."""
    return shingle_hashes([word_list(text)])[0]


def signature(hashes: np.ndarray) -> np.ndarray:
    """Circulant MinHash of a set of shingle hashes: COORDINATES unsigned 16-bit numbers."""
    sigma, circle = _permutations()
    least = np.full(COORDINATES, 1 << UNIVERSE_BITS, dtype=np.int32)
    for i in range(0, len(hashes), 1 << 14):
        places = sigma[(hashes[i:i + (1 << 14)] >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
        np.minimum(least, circle[places].min(axis=0), out=least)
    return least.astype(np.uint16)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts = [word_list(t) for t in b["text"]]
        sets = shingle_hashes(texts)
        yield pd.DataFrame({
            "id": b["id"], "n": [len(s) for s in sets],
            "same": [hashlib.blake2b(b" ".join(t), digest_size=16).digest() for t in texts],
            "sketch": [signature(s).astype("<u2").tobytes() if len(s) else b"" for s in sets]})


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, same, sketch): set size, digest of the word sequence and signature of each row."""
    return docs.select(node_id(key, text).alias("id"), F.col(text).alias("text")).mapInPandas(
        _sign, "id long, n int, same binary, sketch binary")


def bands(nodes: DataFrame) -> DataFrame:
    """(key, band, id): one row per node and band."""
    each = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(
        i.alias("band"), F.xxhash64(i, F.substring(F.col("sketch"), i * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("key")))
    return nodes.select("id", F.explode(each).alias("b")).select("b.key", "b.band", "id")


def _near(a: Column, b: Column) -> Column:
    """Sizes that a pair at the threshold can have."""
    return DENOMINATOR * F.least(a, b) >= NUMERATOR * F.greatest(a, b)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links on their full shingle sets."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            out.append(_linked(recent_shingles(x), recent_shingles(y)))
        return pd.Series(out, dtype=bool)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("at"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("bt"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").where(linked("at", "bt")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every node in a link; comp is the smallest id that it reaches."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
                   .distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # staged, so that both sides of the join are dealt anew and Spark can split a centre's many rows
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = staged(small.select("e.*").where("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")) \
        .unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())


def _tiles(rows: DataFrame, group: str, size: str) -> DataFrame:
    """Rows of a group dealt into tiles (group, b1, b2): pairs of blocks of about TILE members."""
    rows = rows.withColumn("blocks", F.ceil(F.col(size) / TILE).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(
        F.least(i, F.col("own")).alias("b1"), F.greatest(i, F.col("own")).alias("b2")))
    return rows.withColumn("t", F.explode(others)).withColumn("b1", F.col("t.b1")).withColumn("b2", F.col("t.b2")) \
        .drop("t", "blocks", size).repartition(partitions(rows.sparkSession), group, "b1", "b2") \
        .sortWithinPartitions(group, "b1", "b2")


def _by_tile(batches: Iterator[pd.DataFrame], group: str, work) -> Iterator[pd.DataFrame]:
    """``work`` of every tile of rows sorted by tile."""
    held: list[pd.DataFrame] = []
    now = None
    for b in batches:
        keys = [b[c].to_numpy() for c in (group, "b1", "b2")]
        new = np.ones(len(b), dtype=bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
        starts = [*np.flatnonzero(new).tolist(), len(b)]
        for s, e in zip(starts[:-1], starts[1:]):
            key = tuple(x[s] for x in keys)
            if key != now and held:
                out = work(pd.concat(held, ignore_index=True))
                held = []
                if out is not None:
                    yield out
            now = key
            held.append(b.iloc[s:e])
    if held and (out := work(pd.concat(held, ignore_index=True))) is not None:
        yield out


def _across(t: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a tile's rows (i, j) from different components whose sizes fit and whose signatures
    agree enough, and the agreement; in a bucket, pairs that share no earlier band."""
    comp, own, n, m = t["comp"].to_numpy(), t["own"].to_numpy(), t["n"].to_numpy(), len(t)
    none = np.zeros(0, np.int64)
    _, inverse, sizes = np.unique(comp, return_inverse=True, return_counts=True)
    if len(sizes) < 2:
        return none, none, none.astype(float)
    main = inverse == sizes.argmax()  # never two of the largest component
    order = np.concatenate([np.flatnonzero(~main), np.flatnonzero(main)])
    sketch = np.frombuffer(b"".join(t["sketch"]), "<u2").reshape(m, COORDINATES)
    crossing, band = t["b1"].iat[0] != t["b2"].iat[0], int(t["band"].iat[0]) if "band" in t else None
    found = []
    for k in range(int((~main).sum())):
        i, rest = order[k], order[k + 1:]
        ok = (comp[rest] != comp[i]) & (DENOMINATOR * np.minimum(n[rest], n[i]) >= NUMERATOR * np.maximum(n[rest], n[i]))
        if crossing:
            ok &= own[rest] != own[i]
        rest = rest[ok]
        if len(rest):
            same = sketch[rest] == sketch[i]
            est = same.mean(axis=1)
            good = est >= MIN_EST
            if band is not None and good.any():
                good &= same[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
            found.append((np.full(int(good.sum()), i), rest[good], est[good]))
    if not found:
        return none, none, none.astype(float)
    return tuple(np.concatenate(x) for x in zip(*found))


def _cluster(t: pd.DataFrame) -> pd.DataFrame | None:
    """Joins rows of a bucket that may be links across components: (a, b), b one of a's cluster."""
    i, j, _ = _across(t)
    if not len(i):
        return None
    label = np.arange(len(t))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    ids, rows = t["id"].to_numpy(), np.unique(np.concatenate([i, j]))
    rows = rows[label[rows] != rows]
    return pd.DataFrame({"a": ids[rows], "b": ids[label[rows]]})


def _links(t: pd.DataFrame) -> pd.DataFrame | None:
    """Confirmed links (a, b) of a cluster's tile that connect components."""
    i, j, est = _across(t)
    parent = np.unique(t["comp"].to_numpy(), return_inverse=True)[1]
    top = list(range(int(parent.max()) + 1))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    sets: dict[int, np.ndarray] = {}
    texts, ids, out = t["text"].tolist(), t["id"].to_numpy(), []
    for k in np.argsort(-est, kind="stable").tolist():
        x, y = int(i[k]), int(j[k])
        a, b = root(parent[x]), root(parent[y])
        if a == b:
            continue
        for z in (x, y):
            if z not in sets:
                sets[z] = shingle_hashes([word_list(texts[z])])[0]
        if _linked(sets[x], sets[y]):
            top[max(a, b)] = min(a, b)
            out.append((ids[x], ids[y]))
    return pd.DataFrame(out, columns=["a", "b"]) if out else None


def _several(rows: DataFrame, group: str) -> DataFrame:
    """The groups that hold several components, and their numbers of rows."""
    return staged(rows.groupBy(group).agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
        .where("lo <> hi").select(group, "size"), "several")


def clusters(members: DataFrame, nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """(a, b): nodes to be compared within one cluster, from buckets with several components."""
    labelled = members.select("key", "band", "id").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    rows = labelled.join(_several(labelled, "key"), "key").join(nodes, "id")
    return _tiles(rows, "key", "size").mapInPandas(lambda b: _by_tile(b, "key", _cluster), "a long, b long")


def cluster_links(grouped: DataFrame, nodes: DataFrame, comps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) within the clusters (id, cluster)."""
    labelled = grouped.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    rows = labelled.join(_several(labelled, "cluster"), "cluster").join(nodes, "id").join(texts, "id")
    return _tiles(rows, "cluster", "size").mapInPandas(lambda b: _by_tile(b, "cluster", _links), "a long, b long")


def near_links(nodes: DataFrame, docs_texts) -> DataFrame | None:
    """(id, comp) for the nodes (id, n, sketch) that are linked; ``docs_texts(ids)`` gives (id, text)."""
    keyed = bands(nodes)
    # aggregates that go back to their rows are staged: Spark can split a hot key only where both
    # sides of the join are dealt anew
    crowded = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "crowded")
    members = staged(keyed.join(crowded, "key"), "members")
    ids = staged(members.groupBy("id").agg(F.sum("members").alias("weight")), "ids")
    if ids.isEmpty():
        return None
    few = staged(nodes.join(ids, "id"), "candidates")
    texts = staged(docs_texts(ids.select("id")), "texts")

    # 1. every node against its most connected bucket mate
    ranked = members.join(few.select("id", "weight", "n"), "id")
    centre = staged(ranked.groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("id")).alias("minus"), "n")).alias("c")), "centres")
    star = ranked.join(centre, "key").where((F.col("id") != -F.col("c.minus")) & _near(F.col("n"), F.col("c.n"))) \
        .groupBy("id").agg(F.max("c").alias("c")).select(F.col("id").alias("a"), (-F.col("c.minus")).alias("b"))
    star = staged(star, "star")
    links = staged(confirmed(star, texts), "links")
    comps = staged(components(links), "comps")

    # 2. and 3. what may still connect components
    few = few.select("id", "n", "sketch")
    joined = staged(clusters(members, few, comps), "clusters")
    if joined.isEmpty():
        return comps
    grouped_ = staged(components(joined).withColumnRenamed("comp", "cluster"), "clusters")
    more = staged(cluster_links(grouped_, few, comps, texts), "links")
    return comps if more.isEmpty() else staged(components(links.unionByName(more)), "comps")


def node_id(key: str, text: str) -> Column:
    """The row's id; without one, a number from NO_ID on by its text."""
    spare = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 2)
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_ID) + spare)


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, comp) of every row, by node ids."""
    every = staged(signed(docs, key, text), "signed")
    lone = F.col("n") == 0
    # staged, so that both sides of the join are dealt anew and Spark can split a large group of copies
    first = staged(every.where(~lone).groupBy("same").agg(F.min("id").alias("rep")), "first")
    classed = staged(
        every.select("id", "n", "same").join(first, "same", "left")
        .select("id", "n", F.when(lone, F.col("id")).otherwise(F.col("rep")).alias("rep")), "classes")
    reps = classed.where((F.col("id") == F.col("rep")) & ~lone).select("id").distinct()
    nodes = every.join(reps, "id", "left_semi").where(~lone).select("id", "n", "sketch")

    def texts_of(ids: DataFrame) -> DataFrame:
        rows = docs.select(node_id(key, text).alias("id"), F.col(text).alias("text")).where("text is not null")
        return rows.join(_sized(ids), "id", "left_semi")

    comps = near_links(nodes, texts_of)
    if comps is None:
        return classed.select("id", "n", F.col("rep").alias("comp"))
    return classed.join(comps.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("id", "n", F.coalesce("comp", "rep").alias("comp"))


def _sized(ids: DataFrame) -> DataFrame:
    """Broadcast ids where they are few; else Spark shuffles."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row."""
    own = F.when(F.col("id") < NO_ID, F.col("id"))
    named = F.when(F.col("comp") < NO_ID, F.col("comp"))
    return grouped(docs, key, text).select(
        own.cast(docs.schema[key].dataType).alias(key), F.col("n").cast("long").alias("n_shingles"),
        named.alias("component_id"), (F.col("id") == F.col("comp")).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each group (its smallest id; of rows that share it, one), with its columns."""
    found = staged(grouped(docs).groupBy("id").agg(F.min("comp").alias("comp"), F.count(F.lit(1)).alias("rows")), "kept")
    # the row travels as one value, so that no column of the caller's can be taken for the node
    rows = docs.select(node_id("doc_id", "text").alias("node"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = found.where("id = comp and rows = 1").select(F.col("id").alias("node"))
    more = found.where("id = comp and rows > 1").select(F.col("id").alias("node"))
    out = rows.join(_sized(once), "node", "left_semi")
    if not more.isEmpty():  # only repeated rows are shuffled
        out = out.unionByName(rows.join(_sized(more), "node", "left_semi").dropDuplicates(["node"]))
    return out.select("row.*")

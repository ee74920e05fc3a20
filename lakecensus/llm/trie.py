"""Prefix trie of conversations from sorted sequences, by range minima over their common prefixes.

1. ``rebuilt`` gives one row per conversation: the digests of its turns, in order, and their words.
2. Rows are dealt into ranges of the order of their sequences and sorted there. ``common`` gives each
   row the length of the prefix that it shares with the row before (across ranges too).
3. Every prefix that a row doesn't share with the row before is a node, and the row its first member.
   A range is one group: a sparse table holds the minima of all runs of 2^k common lengths, and for
   each candidate (row, depth) binary searches over it, independent of each other, find how far
   members reach to the right and, for the depth above, to the left. There is no stack and no walk
   along the order. Members, smallest ids and sums over subtrees are differences of prefix sums and
   range minima between those bounds.
4. A node that reaches the end of its range goes on in the next: a range has one such *open* node a
   depth at most. The ranges' own minima (one row per range) are a sparse table too, in which the
   open nodes and their parents find the ranges where they end and begin. What the last of these
   holds is joined from its *lead* (one row per depth); whole ranges between add their sums.

Digests of turns are 128 bits of MD5 over role and text; texts are not shuffled. A conversation's
digests (16 bytes a turn) are one row, as they are one sequence. The ids of a node's own conversations
are hashed as a stream, in order, range by range.

Defined cases: null role and text are empty; turns are ordered by (turn, role, digest), a null turn
first, and repeated rows stay; rows without a conversation id belong to no conversation and are left
out; conversations may be empty once rebuilt and are members of the root; other columns are ignored,
whatever their names; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecensus.llm.common import crc32, partitions, staged, words

GROUP, HEADS = 20, 4  # conversations that share a head; its turns are a remainder of this
ROWS_PER_RANGE = 100_000
MAX_RANGES = 65_536
BROADCAST_OPEN = 1_000_000  # open nodes (three numbers each) that are sent to every executor
NOTHING = hashlib.sha256(b"").hexdigest()
NODE, LEAD, ENDS = 0, 1, 2  # kinds of rows that a range gives


# --- sequences ---------------------------------------------------------------------------
def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): digest and words of a conversation's turns, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.struct(
            F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), role.alias("role"),
            digest.alias("digest"), F.size(words(text)).cast("long").alias("words")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, digests, words): the head of the group's first conversation, then the own turns."""
    own = sequences(conversations)
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = own.where(F.col("conv_id") == first).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, HEADS - 1).alias("_head"))
    h = (crc32(F.col("conv_id")) % HEADS).cast("int")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("_head", none), F.lit(1), h),
                     F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return own.join(heads, first == F.col("_first"), "left").select("conv_id", turns.alias("t")).select(
        "conv_id", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))


# --- order -------------------------------------------------------------------------------
def in_ranges(rows: DataFrame) -> DataFrame:
    """The rows with ``rng``, the number of their range of (digests, conv_id); staged."""
    n = min(MAX_RANGES, max(partitions(rows.sparkSession), -(-rows.count() // ROWS_PER_RANGE)))
    return staged(rows.repartitionByRange(n, "digests", "conv_id").withColumn("rng", F.spark_partition_id()), "trie-ranges")


def shared_prefix(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from their start."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    miss = F.array_position(same, False)
    return F.when(miss == 0, F.size(a)).otherwise(miss - 1).cast("long")


def common(ranged: DataFrame) -> DataFrame:
    """(rng, pos, conv_id, length, lcp, words): lcp with the row before, -1 for the first of all;
    the words of the prefixes longer than that."""
    last = ranged.groupBy("rng").agg(F.max(F.struct("digests", "conv_id"))["digests"].alias("_last"))
    before = last.select("rng", F.lag("_last").over(Window.orderBy("rng")).alias("_last"))  # a row per range
    order = Window.partitionBy("rng").orderBy("digests", "conv_id")
    rows = ranged.withColumns({"pos": F.row_number().over(order) - 1, "_lag": F.lag("digests").over(order)})
    prev = F.when(F.col("pos") == 0, F.col("_last")).otherwise(F.col("_lag"))
    lcp = F.when(prev.isNull(), F.lit(-1).cast("long")).otherwise(shared_prefix(prev, F.col("digests")))
    known = F.greatest(F.col("lcp"), F.lit(0)).cast("int")
    return rows.join(before, "rng").select("rng", "pos", "conv_id", "digests", "words", lcp.alias("lcp")).select(
        "rng", "pos", "conv_id", F.size("digests").cast("long").alias("length"), "lcp",
        F.slice("words", known + 1, F.size("words") - known).alias("words"))


class Minima:
    """Sparse table: minima of all runs of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.levels, width = [np.asarray(values, dtype=np.int64)], 1
        while 2 * width <= len(values):
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the values lo to hi, both included."""
        k = np.frexp(hi - lo + 1)[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for level in np.unique(k):
            at = np.flatnonzero(k == level)
            row = self.levels[level]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << level) + 1])
        return out

    def right(self, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """By binary search the last place so that all values behind ``at`` up to it reach the floor."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            row = self.levels[k]
            go = np.flatnonzero(at + 1 < len(row))
            go = go[row[at[go] + 1] >= floor[go]]
            at[go] += 1 << k
        return at

    def left(self, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """By binary search the first place so that all values behind it up to ``at`` reach the floor."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            row, width = self.levels[k], 1 << k
            go = np.flatnonzero(at >= width)
            go = go[row[at[go] - width + 1] >= floor[go]]
            at[go] -= width
        return at


# --- nodes of one range ------------------------------------------------------------------
class Ranges:
    """One row per range, in order: what open nodes need of other ranges."""

    def __init__(self, rows: list):
        self.number = {r["rng"]: n for n, r in enumerate(rows)}
        column = lambda c: np.array([r[c] for r in rows], dtype=np.int64)
        self.first, self.first_length, self.rows = column("first"), column("first_length"), column("rows")
        self.whole = column("whole")  # least lcp of the range
        self.before = np.cumsum(self.rows) - self.rows
        self.minima, self.ids = Minima(self.whole), Minima(column("least_id"))


FOUND = ("kind int, rng int, pos long, depth long, words long, open boolean, n_convs long, conv_id long, n_children long, "
         "n_leaves long, saved_tokens long, ends string, whole_to long, lead_in long, parent_rng long, parent_conv_id long")


def nodes_of_range(t: pa.Table, ranges: Ranges) -> pa.Table:
    """Rows of FOUND. Nodes that end in the range are complete, but for the ids of open parents."""
    t = t.sort_by("pos")
    g, m = ranges.number[t.column("rng")[0].as_py()], t.num_rows
    lcp, length, ids = (t.column(c).to_numpy().astype(np.int64) for c in ("lcp", "length", "conv_id"))
    flat = t.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if lcp[0] < 0:
        flat = np.r_[0, flat]  # the root has no text
    follows = g + 1 < len(ranges.rows)
    follow = ranges.first[g + 1] if follows else -1  # what the next range's first row shares with this one's last
    minima, least = Minima(lcp), Minima(ids)

    # candidates, in preorder: by first member, then by depth
    count = length - lcp
    begin = np.r_[0, np.cumsum(count)]
    row = np.repeat(np.arange(m), count)
    depth = lcp[row] + 1 + np.arange(len(row)) - begin[row]
    right = minima.right(row, depth)
    is_open = (right == m - 1) & (follow >= depth)

    # the depth above, searched for by itself to both sides
    up = depth - 1
    up_left, up_right = minima.left(row, up), minima.right(row, up)
    outside = (up_left == 0) & (lcp[0] >= up) & (up >= 0)
    up_open = (up >= 0) & ~outside & (up_right == m - 1) & (follow >= up)
    inside = (up >= 0) & ~outside
    parent_rng = np.full(len(row), -1, dtype=np.int64)
    parent_rng[up_open] = g
    if outside.any():
        parent_rng[outside] = ranges.minima.left(np.full(int(outside.sum()), g - 1), up[outside])
    parent_id = least.least(up_left, np.maximum(up_left, up_right))
    children = np.zeros(len(row), dtype=np.int64)
    np.add.at(children, begin[up_left[inside]] + up[inside] - lcp[up_left[inside]] - 1, 1)

    members, smallest = right - row + 1, least.least(row, right)
    value = np.where(is_open, 0, (members - 1) * flat)
    leaf = ~is_open & (children == 0)
    sums, leaves = np.r_[0, np.cumsum(value)], np.r_[0, np.cumsum(leaf)]
    stop = begin[right + 1]  # behind the last node of the subtree, as far as this range goes
    saved, n_leaves = sums[stop] - sums[:-1], leaves[stop] - leaves[:-1]

    whole_to = np.full(len(row), g, dtype=np.int64)  # the last range that an open node holds wholly (or its own)
    lead_in = np.full(len(row), -1, dtype=np.int64)
    at = np.flatnonzero(is_open)
    if len(at):
        to = ranges.minima.right(np.full(len(at), g), depth[at])
        whole_to[at] = to
        nxt = np.minimum(to + 1, len(ranges.rows) - 1)
        part = (to + 1 < len(ranges.rows)) & (ranges.first[nxt] >= depth[at])
        lead_in[at[part]] = nxt[part]
        members[at] += ranges.before[to] + ranges.rows[to] - ranges.before[g] - ranges.rows[g]
        more = to > g
        smallest[at[more]] = np.minimum(smallest[at[more]], ranges.ids.least(np.full(int(more.sum()), g + 1), to[more]))

    # conversations that end in a node are a run of equal rows
    new = np.r_[np.flatnonzero(count > 0), m]
    ends = np.full(len(row), NOTHING, dtype=object)
    pending = np.zeros(len(row), dtype=bool)
    texts = ids.astype(str)
    goes_on = follows and ranges.first_length[g + 1] == follow  # the next range begins with the same conversation
    for first, end in zip(new, new[1:]):
        node = begin[first + 1] - 1
        if end == m and goes_on and length[first] == follow:
            pending[node] = True
            ends[node] = ",".join(texts[first:end])
        else:
            ends[node] = hashlib.sha256(",".join(texts[first:end]).encode()).hexdigest()

    def found(kind: int, n: int, **columns) -> pa.Table:
        fill = {"kind": kind, "rng": g, "open": False}
        arrays = []
        for name, type_ in ((f.split() for f in FOUND.split(", "))):
            what = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[type_]
            if name in columns:
                arrays.append(pa.array(columns[name], what, from_pandas=True))
            else:
                arrays.append(pa.repeat(pa.scalar(fill.get(name), what), n))
        return pa.table(arrays, names=[f.split()[0] for f in FOUND.split(", ")])

    hidden = up_open | outside
    out = [found(NODE, len(row), pos=row, depth=depth, words=flat, open=is_open, n_convs=members, conv_id=smallest,
                 n_children=children, n_leaves=n_leaves, saved_tokens=saved, ends=np.where(pending, None, ends),
                 whole_to=whole_to, lead_in=lead_in, parent_rng=np.where(hidden, parent_rng.astype(object), None),
                 parent_conv_id=np.where(hidden | (up < 0), None, parent_id.astype(object)))]
    if g and lcp[0] > ranges.whole[g]:
        deep = np.arange(ranges.whole[g] + 1, lcp[0] + 1)
        to = minima.right(np.zeros(len(deep), dtype=np.int64), deep)
        out.append(found(LEAD, len(deep), depth=deep, n_convs=to + 1, conv_id=least.least(np.zeros_like(to), to),
                         n_leaves=leaves[begin[to + 1]], saved_tokens=sums[begin[to + 1]]))
    chunks = [(g, int(depth[n]), ends[n]) for n in np.flatnonzero(pending)]
    if g and lcp[0] == length[0]:  # goes on with the last conversation before
        opener = ranges.minima.left(np.array([g - 1]), lcp[:1])[0]
        chunks.append((int(opener), int(lcp[0]), ",".join(texts[:new[0]])))
    if chunks:
        out.append(found(ENDS, len(chunks), parent_rng=[c[0] for c in chunks], depth=[c[1] for c in chunks],
                         ends=[c[2] for c in chunks]))
    return pa.concat_tables(out)


# --- nodes that reach over ranges --------------------------------------------------------
def digests_of_ends(found: DataFrame) -> DataFrame:
    """(rng, depth, ends): one hash over the ids that several ranges hold, read in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for batch in batches:
            for rng, depth, text in zip(batch["at"], batch["depth"], batch["ends"]):
                if (rng, depth) != key:
                    if key is not None:
                        yield pd.DataFrame({"rng": [key[0]], "depth": [key[1]], "ends": [digest.hexdigest()]})
                    key, digest = (rng, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.encode())
        if key is not None:
            yield pd.DataFrame({"rng": [key[0]], "depth": [key[1]], "ends": [digest.hexdigest()]})

    chunks = found.where(F.col("kind") == ENDS).select(F.col("parent_rng").alias("at"), "depth", "rng", "ends")
    return chunks.repartition("at", "depth").sortWithinPartitions("at", "depth", "rng").mapInPandas(
        run, "rng long, depth long, ends string")


def open_nodes(found: DataFrame, n_ranges: int) -> DataFrame:
    """The open nodes with all that later ranges hold of them; staged."""
    leads = found.where(F.col("kind") == LEAD).select(
        F.col("rng").cast("long").alias("lead_in"), "depth", F.col("n_convs").alias("l_convs"), F.col("conv_id").alias("l_id"),
        F.col("n_leaves").alias("l_leaves"), F.col("saved_tokens").alias("l_saved"))
    later = found.where((F.col("kind") == NODE) & F.col("parent_rng").isNotNull() & (F.col("parent_rng") != F.col("rng"))).groupBy(
        F.col("parent_rng").alias("rng"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("c_more"))
    ends = digests_of_ends(found).withColumnRenamed("ends", "e_all")
    zero = F.lit(0).cast("long")
    one = (found.where((F.col("kind") == NODE) & F.col("open")).withColumn("rng", F.col("rng").cast("long"))
           .join(leads, ["lead_in", "depth"], "left").join(later, ["rng", "depth"], "left").join(ends, ["rng", "depth"], "left")
           .withColumns({"n_convs": F.col("n_convs") + F.coalesce("l_convs", zero), "conv_id": F.least("conv_id", "l_id"),
                         "n_children": F.col("n_children") + F.coalesce("c_more", zero), "ends": F.coalesce("ends", "e_all")})
           .withColumns({"v_saved": (F.col("n_convs") - 1) * F.col("words"),
                         "v_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")}))
    one = staged(one, "trie-open")

    # subtrees: this range behind the node in preorder, the whole ranges after it, the lead of the last
    behind = Window.partitionBy("rng").orderBy(F.desc("pos"), F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    closed = found.where((F.col("kind") == NODE) & ~F.col("open")).groupBy(F.col("rng").cast("long").alias("rng")).agg(
        F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"))
    opened = one.groupBy("rng").agg(F.sum("v_saved").alias("saved"), F.sum("v_leaves").alias("leaves"))
    none = found.sparkSession.range(n_ranges).select(F.col("id").alias("rng"), zero.alias("saved"), zero.alias("leaves"))
    upto = Window.orderBy("rng").rowsBetween(Window.unboundedPreceding, 0)  # a row per range
    totals = none.unionByName(closed).unionByName(opened).groupBy("rng").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).select(
        "rng", F.sum("saved").over(upto).alias("saved"), F.sum("leaves").over(upto).alias("leaves"))
    here = totals.select("rng", F.col("saved").alias("h_saved"), F.col("leaves").alias("h_leaves"))
    there = totals.select(F.col("rng").alias("whole_to"), F.col("saved").alias("t_saved"), F.col("leaves").alias("t_leaves"))

    def whole(what: str) -> Column:
        return (F.col(f"own_{what}") + F.col(f"b_{what}") + F.col(f"t_{what}") - F.col(f"h_{what}") + F.coalesce(f"l_{what}", zero))

    summed = one.withColumns({"b_saved": F.sum("v_saved").over(behind), "b_leaves": F.sum("v_leaves").over(behind)}).withColumnsRenamed(
        {"saved_tokens": "own_saved", "n_leaves": "own_leaves"}).join(here, "rng").join(there, "whole_to")
    return staged(summed.withColumns({"saved_tokens": whole("saved"), "n_leaves": whole("leaves")}).select(
        "rng", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "parent_rng", "parent_conv_id"), "trie-open")


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(rows: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, digests, words)."""
    spark = rows.sparkSession
    lined = staged(common(in_ranges(staged(rows, "trie-rows"))), "trie-common")
    summary = lined.groupBy("rng").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("lcp", "pos").alias("first"), F.min("lcp").alias("whole"),
        F.min_by("length", "pos").alias("first_length"), F.min("conv_id").alias("least_id")).orderBy("rng").collect()  # MAX_RANGES at most
    if not summary:
        return spark.createDataFrame([], ", ".join(f"{c} {'string' if c == RESULT[-1] else 'long'}" for c in RESULT))
    ranges = Ranges(summary)
    found = staged(lined.groupBy("rng").applyInArrow(lambda t: nodes_of_range(t, ranges), FOUND), "trie-nodes")
    reaching = open_nodes(found, len(summary))
    columns = ["depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "parent_rng", "parent_conv_id"]
    every = found.where((F.col("kind") == NODE) & ~F.col("open")).select(columns).unionByName(reaching.select(columns))
    parents = reaching.select(F.col("rng").alias("parent_rng"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_parent"))
    if reaching.count() <= BROADCAST_OPEN:
        parents = F.broadcast(parents)
    return every.join(parents, ["parent_rng", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    return trie(rebuilt(conversations))

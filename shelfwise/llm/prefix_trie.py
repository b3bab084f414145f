"""Trie of conversation prefixes, balanced parentheses per shard, shared spines merged.

Conversations become sequences of turn digests (128 bits of SHA-256 of role and
text). They are range-partitioned and sorted by (sequence, id), so that equal
sequences are split as well, and each task cuts its sorted run into shards of a
fixed number of turns. A shard's trie is a string of parentheses in preorder:

* ``findclose`` searches the excess (open minus closed so far) through blocks of
  range minima and delimits each subtree;
* the rank of leaf pairs ``()`` gives the leaves of a subtree, running sums over
  the opening parentheses give its savings and its members;
* members are neighbours in the sorted run: the smallest id of a range comes
  from a table of minima over powers of two.

A node that isn't a prefix of the shard's first or last sequence has all its members
in the shard and is finished there. The others, the shard's two spines, may go on
in other shards: their parts are added up by node, the finished value of each
spine node is sent back to one shard that holds it, added up along that shard's
spine, and these sums are added up by node once more. All steps are joins and
groupings of a few rows a shard and depth; the ids that end in a spine node
travel as one string a shard and are hashed in order as a stream.

Nulls and edge cases. NULL roles and texts are empty, a NULL turn comes first;
turns of equal number are ordered by their digest. Turns without a conversation id
belong to no conversation and are left out. Repeated rows are turns of their own.
An empty table has no nodes, not even a root. Other columns are ignored. A
conversation's digests are held as one record (about 40 bytes a turn), its texts
are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import batch_of, partitions, stored

#: A shard ends with the conversation that reaches so many turns (a turnless one counts as one).
SHARD_TURNS = 1 << 16
#: Parentheses a block of the lowest level, blocks of one level a block of the next.
BLOCK, FAN = 64, 16
DIGEST = 16

_SCHEMA = ("shard bigint, path int, depth bigint, node binary, parent binary, conv_id bigint, parent_conv_id bigint, "
           "parent_depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, "
           "ends string, ends_sha256 string")
_ARROW = pa.schema([
    ("shard", pa.int64()), ("path", pa.int32()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
    ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_depth", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()),
    ("ends", pa.string()), ("ends_sha256", pa.string())])


class Parentheses:
    """A balanced sequence (+1 opens, -1 closes) with its excess and blocks of excess minima."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        self.excess = np.cumsum(steps, dtype=np.int64)
        self.levels = []
        low, width = self.excess, BLOCK
        while len(low) > 1:
            pad = -len(low) % width
            low = np.concatenate([low, np.full(pad, np.iinfo(np.int64).max)]).reshape(-1, width).min(axis=1)
            self.levels.append(low)
            width = FAN
        leaf = np.zeros(len(steps), bool)
        leaf[:-1] = (steps[:-1] == 1) & (steps[1:] == -1)
        self.leaf_pairs = np.cumsum(leaf)
        self.opens = np.cumsum(steps == 1)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """For each open parenthesis at ``at`` the place of its closing one: the first later place of smaller excess."""
        goal = self.excess[at] - 1
        place = at + 1
        out = np.full(len(at), -1, np.int64)
        todo = np.arange(len(at))
        widths = [BLOCK] + [FAN] * (len(self.levels) - 1)

        def walk(values: np.ndarray, where: np.ndarray, of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
            """Go right from ``where`` inside its block of ``width``; returns the hits' mask and places."""
            end = np.minimum((where // width + 1) * width, len(values))
            where = where.copy()
            open_ = np.flatnonzero(where < end)
            hit = np.zeros(len(where), bool)
            while len(open_):
                good = values[where[open_]] <= goal[of[open_]]
                hit[open_[good]] = True
                open_ = open_[~good]
                where[open_] += 1
                open_ = open_[where[open_] < end[open_]]
            return hit, where

        # Up: look in the rest of the block, then in the blocks beside it, level by level.
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * (len(self.levels) + 1)
        rows = [self.excess, *self.levels]
        for level in range(len(rows)):
            width = widths[level] if level < len(widths) else len(rows[level])
            hit, where = walk(rows[level], place, todo, width)
            found[level] = (todo[hit], where[hit])
            todo = todo[~hit]
            if not len(todo):
                break
            place = (where[~hit] - 1) // width + 1
        # Down: the first small enough entry of the block found, level by level.
        which, where = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for level in range(len(rows) - 1, -1, -1):
            if len(which):
                hit, where = walk(rows[level], where * widths[level], which, widths[level])
            which, where = np.concatenate([which, found[level][0]]), np.concatenate([where, found[level][1]])
        out[which] = where
        return out


def range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of ``values[lo:hi]`` for each non-empty range, from minima over powers of two."""
    out = np.empty(len(lo), values.dtype)
    power = np.frexp((hi - lo).astype(np.float64))[1] - 1
    table, width = values, 1
    for k in range(int(power.max(initial=0)) + 1):
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - width])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def shared_turns(digests: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each sequence, the turns at its front that it shares with the one before (the first one: none)."""
    n = len(start)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    most = np.minimum(length[1:], length[:-1])
    out[1:] = most
    own = np.repeat(np.arange(1, n), most)
    step = np.arange(len(own)) - np.repeat(np.cumsum(most) - most, most)
    differ = (digests[start[own] + step] != digests[start[own - 1] + step]).any(axis=1)
    np.minimum.at(out, own[differ], step[differ])
    return out


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _path_keys(digests: np.ndarray) -> list[bytes]:
    """128-bit names of the prefixes of a sequence, the empty one first."""
    state = hashlib.sha256()
    out = [state.digest()[:DIGEST]]
    for row in digests:
        state.update(row.tobytes())
        out.append(state.copy().digest()[:DIGEST])
    return out


def shard_nodes(shard: int, convs: np.ndarray, length: np.ndarray, digests: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """The trie of sorted sequences: finished nodes (``node`` NULL) and the parts of the two spines."""
    n = len(convs)
    start = np.cumsum(length) - length
    shared = shared_turns(digests, start, length)
    new = length - shared
    # Parentheses: the root, then each sequence closes what it doesn't share and opens the rest.
    close = np.concatenate([[0], length[:-1] - shared[1:]])
    runs = np.empty(2 * n, np.int64)
    runs[0::2], runs[1::2] = close, new
    steps = np.repeat(np.tile([-1, 1], n), runs)
    steps = np.concatenate([[1], steps, np.full(length[-1] + 1, -1)])
    tree = Parentheses(steps)
    opens = np.flatnonzero(steps == 1)
    m = len(opens)
    closes = tree.findclose(opens)
    last = tree.opens[closes]  # nodes in preorder up to the end of the subtree
    depth = tree.excess[opens] - 1
    owner = np.concatenate([[0], np.repeat(np.arange(n), new)])  # the first sequence through the node
    turn = start[owner] + depth - 1
    node_words = np.where(depth > 0, words[np.maximum(turn, 0)] if len(words) else 0, 0)
    # The node where each sequence ends: the last one opened so far, as a sequence that opens none equals the one before.
    end = np.cumsum(new)
    ended = np.bincount(end, minlength=m)
    upto = np.concatenate([[0], np.cumsum(ended)])
    member_lo, member_hi = upto[:-1], upto[last]
    smallest = range_min(convs, member_lo, member_hi)
    n_convs = member_hi - member_lo

    # Parents: the closest earlier node one level up.
    order = np.lexsort((np.arange(m), depth))
    keys = depth[order] * (m + 1) + order
    parent = np.empty(m, np.int64)
    parent[order] = order[np.searchsorted(keys, keys - (m + 1)) - 1]
    parent[0] = -1
    children = np.bincount(parent[1:], minlength=m)

    spine = [np.zeros(0, np.int64)] * 2
    for k, i in enumerate((0, n - 1)):
        path = np.empty(length[i] + 1, np.int64)
        at = end[i]
        for d in range(length[i], -1, -1):
            path[d] = at
            at = parent[at]
        spine[k] = path
    on_spine = np.zeros(m, bool)
    on_spine[spine[0]] = on_spine[spine[1]] = True
    free = ~on_spine
    saved = np.where(free, (n_convs - 1) * node_words, 0)
    leaves_before = tree.leaf_pairs[opens] - (steps[np.minimum(opens + 1, len(steps) - 1)] == -1)
    leaves = tree.leaf_pairs[closes] - leaves_before
    spine_leaf = np.concatenate([[0], np.cumsum(on_spine & (children == 0))])
    leaves = leaves - (spine_leaf[last] - spine_leaf[:-1])
    sums = np.concatenate([[0], np.cumsum(saved)])
    saved_below = sums[last] - sums[:-1]
    free_children = np.bincount(parent[1:][free[1:]], minlength=m)

    names = convs.astype(str)

    def ids(v: int) -> str:
        return ",".join(names[upto[v]:upto[v + 1]])

    done = np.flatnonzero(free)
    empty = _sha("")
    top = on_spine[parent[done]] if len(done) else np.zeros(0, bool)
    inner = ~top
    paths = [_path_keys(digests[start[i]:start[i] + length[i]]) for i in (0, n - 1)]
    short = min(map(len, spine))
    both = int((spine[0][:short] == spine[1][:short]).sum())
    path_of = np.zeros(m, np.int32)
    path_of[spine[1][both:]] = 1
    columns: list[list] = [
        [shard] * len(done), [int(path_of[parent[v]]) for v in done], depth[done].tolist(), [None] * len(done), [None] * len(done),
        smallest[done].tolist(), [int(smallest[parent[v]]) if f else None for v, f in zip(done, inner)],
        [None if f else int(depth[parent[v]]) for v, f in zip(done, inner)], n_convs[done].tolist(), children[done].tolist(),
        leaves[done].tolist(), saved_below[done].tolist(), node_words[done].tolist(), [None] * len(done),
        [_sha(ids(v)) if ended[v] else empty for v in done]]
    for k in (0, 1):
        for d, v in enumerate(spine[k]):
            own = k == 0 or d >= both  # a node of both spines counts once
            row = (shard, k, d, paths[k][d], paths[k][d - 1] if d else None, int(smallest[v]), None, None,
                   int(n_convs[v]) if own else 0, int(free_children[v]) if own else 0, int(leaves[v]) if own else 0,
                   int(saved_below[v]) if own else 0, int(node_words[v]), ids(v) if own and ended[v] else None, None)
            for column, value in zip(columns, row):
                column.append(value)
    return batch_of(_ARROW, columns)


def _shards(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a sorted run of (conv_id, seq, words) into shards; a shard's number says its place in the whole order."""
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        convs = table["conv_id"].to_numpy()
        words = table["words"].combine_chunks()
        length = np.diff(words.offsets.to_numpy()).astype(np.int64)
        flat = b"".join(table["seq"].to_pylist())
        return shard_nodes(number, convs, length, np.frombuffer(flat, ">u8").reshape(-1, 2), words.flatten().to_numpy())

    for batch in batches:
        turns = np.maximum(np.diff(batch.column("words").offsets.to_numpy()), 1)
        ends = np.cumsum(turns)
        lo = 0
        while lo < batch.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = min(int(np.searchsorted(ends, before + limit - size)) + 1, batch.num_rows)
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi - 1] - before)
            lo = hi
            if size >= limit:
                yield flush()
                held, size, number = [], 0, number + 1
    if held:
        yield flush()


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as (digest in hex, words of the text)."""
    r, t = F.coalesce(turns[role].cast("string"), F.lit("")), F.coalesce(turns[text].cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256), 1, 2 * DIGEST)
    rows = turns.select(turns[conv].cast("long").alias("conv_id"), turns[turn].cast("long").alias("turn"), digest.alias("d"),
                        F.size(F.regexp_extract_all(t, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"))
    # NULL sorts first in an array of structs
    each = F.sort_array(F.collect_list(F.struct("turn", "d", "w")))
    return rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.transform(each, lambda x: F.struct(x["d"].alias("d"), x["w"].alias("w"))).alias("turns"))


def rebuilt(convs: DataFrame, every: int = 20, draws: int = 4) -> DataFrame:
    """Each conversation with its first turns replaced by those of the conversation ``conv_id - conv_id % every``:
    as many as crc32 of the decimal id leaves modulo ``draws``."""
    convs = stored(convs, "sequences")
    heads = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, draws - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(draws)).cast("int")
    joined = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % every}).join(heads, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("turns"))


def _hashed_ends(parts: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of (node, shard, ends): the ends of a node, in shard order, hashed as one stream."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
        node, state = None, None
        for batch in batches:
            out = []
            for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if key != node:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            if out:
                yield batch_of(schema, list(zip(*out)))
        if state is not None:
            yield batch_of(schema, [[node], [state.hexdigest()]])

    spread = parts.repartition(partitions(parts.sparkSession), "node").sortWithinPartitions("node", "shard", "path")
    return spread.select("node", "ends").mapInArrow(apply, "node binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``convs (conv_id, turns)``, a row each: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = convs.sparkSession
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t["d"]), ""))
    rows = stored(convs.select("conv_id", seq.alias("seq"), F.transform("turns", lambda t: t["w"].cast("long")).alias("words")), "rebuilt")
    ordered = rows.repartitionByRange(partitions(spark), "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = stored(ordered.mapInArrow(lambda batches: _shards(batches, shard_turns), _SCHEMA), "shards")
    spines = parts.where("node IS NOT NULL")

    # 1. The spine nodes' own parts, added up.
    merged = spines.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("free_children"),
        F.sum("n_leaves").alias("free_leaves"), F.sum("saved_tokens").alias("free_saved"), F.min(F.struct("shard", "path")).alias("holder"))
    below = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("spine_children"))
    merged = stored(merged.join(below, "node", "left").withColumn("n_children", F.col("free_children") + F.coalesce("spine_children", F.lit(0)))
                    .drop("spine_children", "free_children"), "spines")
    # 2. Each spine node's own leaf and saving, added up along the spine of the shard that holds it.
    own = merged.select(F.col("holder.shard").alias("shard"), F.col("holder.path").alias("path"), "depth",
                        (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("value"))
    upward = Window.partitionBy("shard", "path").orderBy(F.desc("depth"))
    along = spines.select("shard", "path", "depth", "node").join(own, ["shard", "path", "depth"], "left").select(
        "node", F.sum(F.coalesce("leaf", F.lit(0))).over(upward).alias("leaves"), F.sum(F.coalesce("value", F.lit(0))).over(upward).alias("saved"))
    totals = along.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    ends = _hashed_ends(spines.where("ends IS NOT NULL").select("node", "shard", "path", "ends"))
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shared = merged.join(totals, "node").join(ends, "node", "left").join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("free_leaves") + F.col("leaves")).alias("n_leaves"),
        (F.col("free_saved") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_sha(""))).alias("ends_sha256"))

    # 3. Finished nodes; the parent of a top one is a spine node, looked up by its place in the shard.
    places = spines.select("shard", "path", F.col("depth").alias("parent_depth"), "node").join(
        merged.select("node", F.col("conv_id").alias("top")), "node").drop("node")
    done = parts.where("node IS NULL")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = done.where("parent_conv_id IS NOT NULL").select(columns)
    tops = done.where("parent_conv_id IS NULL").drop("parent_conv_id").join(places, ["shard", "path", "parent_depth"]).withColumnRenamed("top", "parent_conv_id")
    return inner.unionByName(tops.select(columns)).unionByName(shared)


def as_contract(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", *[F.col(c).cast("long").alias(c) for c in
                                     ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")], "ends_sha256")

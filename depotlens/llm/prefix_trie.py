"""The trie of conversation prefixes, from sorted conversations and range minima over their common prefixes.

A conversation is its sequence of turns (role, text); a node of depth d is a distinct sequence of first d turns, and
its members are the conversations that start with it. Once conversations are sorted, a node's members stand side
by side: from any of them the node reaches as far left and right as neighbours share d turns or more. A sparse
table of range minima over the lengths that neighbours share (LCPs) answers that, so every candidate prefix
finds its left and right extent by binary search, independently of all others and without a stack.

1. Turns are known by 128-bit digests of role and text. Equal conversations become one sequence with a multiplicity.
2. Sequences are sorted by range partitions and stored as blocks of about ``block_turns`` turns, one row each.
3. In each block, sequence i brings the candidates of depth LCP(i) + 1 to its length. Members, smallest ``conv_id``
   and children come from the extents; leaves and tokens of a whole subtree are a stretch of the candidates in order.
   Nodes that reach over a block's edge are prefixes of its first or last sequence: their members are summed by
   prefix digest over all blocks and handed back, then the blocks' parts of the other sums are added up the same way.

A third of all conversations with one first turn, or all alike, is thus spread over many blocks, and no task holds a
node's members. The digest of the ids that end at a node has to read them in order: ranges of ids are put into text
in parallel, and only these texts meet in one task, as a stream. A conversation's turn digests (24 bytes a turn)
stand in one row, its texts never do. Per range partition its first and last sequence come to the driver.

Turns stand by ``turn`` (null first), then digest; a null role or text is empty, a null ``turn`` is a turn, repeated
rows are repeated turns, rows without ``conv_id`` are left out, other columns are not read. Without conversations
there is no node, not even the root.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.kernels import Powers, mix, ranges
from depotlens.llm.literals import literal_table
from depotlens.session import materialize

ENDS_NONE = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing


# -- conversations --------------------------------------------------------------------------------


def turn_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, x, y, chars): turns by the halves of their digest, and the code points of their text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    numbers = [F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")]
    given = rows.select(*numbers, half(1).alias("x"), half(17).alias("y"), F.char_length(text).cast("long").alias("chars"))
    return given.where("conv_id is not null")


def in_order(turns: DataFrame, *keys: str) -> DataFrame:
    """(keys, turns): one row per conversation, its turns as an array in order."""
    return turns.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("turn", "x", "y", "chars"))).alias("turns"))


def shared_starts(rows: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, turns) of all conversations, each rebuilt to start as the first one of its family does.

    Conversation c begins with the first h turns of conversation c - c % family (all if fewer, none if there is no such
    conversation) and goes on with its own turns after its first h; h is crc32 of the decimal c, modulo ``most``.
    """
    base = F.col("conv_id") - F.col("conv_id") % family
    turns = turn_rows(rows).withColumn("base", base).repartition("base")
    whole = in_order(turns, "base", "conv_id")
    head = whole.where("conv_id = base").select("base", F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = whole.join(head, "base", "left").withColumn("h", h)
    own = F.when(F.size("turns") > F.col("h"), F.expr("slice(turns, h + 1, size(turns))"))
    first = F.when(F.col("h") > 0, F.expr("slice(head, 1, h)"))
    nothing = F.expr("slice(turns, 1, 0)")
    return joined.select("conv_id", F.concat(F.coalesce(first, nothing), F.coalesce(own, nothing)).alias("turns"))


# -- arrays of one block --------------------------------------------------------------------------


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all stretches of 1, 2, 4, ... values, by their start."""
    table = [values]
    while 2 * (1 << len(table) - 1) <= len(values):
        last, step = table[-1], 1 << len(table) - 1
        table.append(np.minimum(last[:-step], last[step:]))
    return table


def range_minimum(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low .. high], both included, for every pair."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), dtype=table[0].dtype)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][low[own]], table[k][high[own] + 1 - (1 << int(k))])
    return out


def extents(table: list[np.ndarray], n: int, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left, right): how far the first ``depth`` turns of sequence ``at`` reach among n sorted sequences.

    ``table`` holds the minima of the n - 1 lengths shared by neighbours (i, i + 1).
    """
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step, minima = 1 << k, table[k]
        fits = right + step < n
        fits[fits] = minima[right[fits]] >= depth[fits]
        right[fits] += step
        fits = left >= step
        fits[fits] = minima[left[fits] - step] >= depth[fits]
        left[fits] -= step
    return left, right


class PrefixDigests:
    """128-bit digests of the prefixes of a sequence of turns."""

    def __init__(self):
        self.bases = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)

    def of(self, turns: np.ndarray) -> list[np.ndarray]:
        """Both halves for the depths 0, 1, ... of ``turns`` (two numbers a turn)."""
        depth = np.arange(len(turns) // 2 + 1)
        values, zero = mix(turns.view(np.uint64)), np.zeros(len(depth), dtype=np.int64)
        return [mix(b.sums(values, zero, 2 * depth) ^ depth.astype(np.uint64)).view(np.int64) for b in self.bases]


def common_turns(one: np.ndarray, other: np.ndarray) -> int:
    n = min(len(one), len(other))
    differ = np.flatnonzero(one[:n] != other[:n])
    return int(differ[0] if len(differ) else n) // 2


class Block:
    """Sorted distinct sequences and the nodes among them.

    ``before`` and ``after`` are the turns shared with the sequences on either side of the block, -1 where there is none.
    """

    def __init__(self, lengths, turns, chars, many, least, before: int, after: int):
        n = len(lengths)
        self.n, self.lengths, self.before, self.after = n, lengths, before, after
        ends = np.cumsum(lengths)
        self.starts, self.turns, self.chars = ends - lengths, turns, chars
        # Turns that sequence i + 1 shares with sequence i: the run of equal turns from their starts.
        shorter = np.minimum(lengths[:-1], lengths[1:])
        at = ranges(np.zeros(n - 1, dtype=np.int64), shorter) if n > 1 else np.zeros(0, dtype=np.int64)
        left = np.repeat(self.starts[:-1], shorter) + at
        right = np.repeat(self.starts[1:], shorter) + at
        pairs = turns.reshape(-1, 2)
        same = (pairs[left] == pairs[right]).all(axis=1) if len(left) else np.zeros(0, dtype=bool)
        shared = shorter.copy()
        owner = np.repeat(np.arange(max(0, n - 1)), shorter)
        wrong = np.flatnonzero(~same)
        np.minimum.at(shared, owner[wrong], at[wrong])
        self.shared = np.concatenate(([before], shared)).astype(np.int64)
        self.table = sparse_table(shared.astype(np.int64))
        self.least, self.many = sparse_table(least), np.concatenate(([0], np.cumsum(many)))
        # Candidates in order of sequence and depth; those of the first sequence include what reaches in from the left.
        low = self.shared + 1
        low[0] = 0
        count = lengths - low + 1
        self.first = np.cumsum(count) - count
        self.at = np.repeat(np.arange(n), count)
        self.depth = ranges(low, count)
        self.left, self.right = extents(self.table, n, self.at, self.depth)
        self.inherited = (self.at == 0) & (self.depth <= before)
        self.reaches_on = (self.right == n - 1) & (self.depth <= after)
        self.crossing = self.inherited | self.reaches_on

    def members(self) -> tuple[np.ndarray, np.ndarray]:
        """(conversations, smallest conv_id) of each candidate, as far as the block knows."""
        return self.many[self.right + 1] - self.many[self.left], range_minimum(self.least, self.left, self.right)

    def nodes(self, left_known: tuple[np.ndarray, np.ndarray], right_known: tuple[np.ndarray, np.ndarray]):
        """(depth, conv_id, parent, n_convs, n_children, n_leaves, saved) of all candidates.

        ``left_known`` and ``right_known``: (conversations, smallest conv_id) by depth of the nodes that cross the edges.
        Sums of crossing nodes are this block's part.
        """
        convs, least = self.members()
        total = len(self.at)
        for side, (known_convs, known_least) in ((self.inherited, left_known), (self.reaches_on, right_known)):
            convs[side], least[side] = known_convs[self.depth[side]], known_least[self.depth[side]]
        own = ~self.inherited
        # The last turn of a candidate; the root has none.
        there = np.flatnonzero(own & (self.depth > 0))
        weight = np.zeros(total, dtype=np.int64)
        weight[there] = (convs[there] - 1) * self.chars[self.starts[self.at[there]] + self.depth[there] - 1]
        following = np.append(self.shared[1:], self.after)
        leaf = own & (self.depth == self.lengths[self.at]) & (following[self.at] < self.depth)
        # A subtree is a stretch of candidates: from the node to the last one of the last member.
        last = np.append(self.first[1:], total)[self.right]
        here = np.arange(total)
        sums = [np.concatenate(([0], np.cumsum(v))) for v in (weight, leaf.astype(np.int64))]
        saved, leaves = (s[last] - s[here] for s in sums)
        # A later member brings a child where it shares exactly the node's turns with the one before it.
        wide = np.int64(self.n + 1)
        order = np.sort((self.shared + 1) * wide + np.arange(self.n))
        begin = np.where(self.inherited, 0, self.at + 1)
        brought = (self.depth + 1) * wide
        children = np.searchsorted(order, brought + self.right, "right") - np.searchsorted(order, brought + begin, "left")
        children += own & (self.lengths[self.at] > self.depth)
        # The parent is one turn shorter: the candidate before, but for the first candidate of a sequence.
        parent = np.roll(least, 1)
        fresh = np.flatnonzero(np.isin(here, self.first) & (self.at > 0))
        at, up = self.at[fresh], self.depth[fresh] - 1
        low, high = extents(self.table, self.n, at, up)
        value = range_minimum(self.least, low, high)
        from_left = (low == 0) & (up <= self.before)
        value[from_left] = left_known[1][up[from_left]]
        to_right = (high == self.n - 1) & (up <= self.after) & ~from_left
        value[to_right] = right_known[1][up[to_right]]
        parent[fresh] = value
        return self.depth, least, parent, convs, children, leaves, saved


# -- stored blocks --------------------------------------------------------------------------------

BLOCK = (
    "part int, block long, lengths binary, turns binary, chars binary, many binary, least binary, ends array<string>, "
    "before int, after int, head binary, tail binary"
)
NAMES = [part.split()[0] for part in BLOCK.split(", ")]


def store_blocks(sequences: DataFrame, block_turns: int) -> DataFrame:
    """Sorted sequences (key, chars, many, least, ends) as rows of one block each.

    ``before`` and ``after`` are null at the edges of a range partition, where ``head`` or ``tail`` has the sequence.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ready: dict | None = None  # the block before, until the first sequence behind it is known
        rows: list[list] = [[] for _ in range(5)]
        size = 0

        def batch_of(row: dict) -> pa.RecordBatch:
            kinds = {"part": pa.int32(), "block": pa.int64(), "ends": pa.list_(pa.string()), "before": pa.int32(), "after": pa.int32()}
            return pa.RecordBatch.from_arrays([pa.array([row[n]], kinds.get(n, pa.binary())) for n in NAMES], names=NAMES)

        def close() -> dict:
            keys, chars, many, least, ends = rows
            before = None if ready is None else common_turns(ready["_last"], keys[0])
            return {
                "part": part,
                "block": (part << 32) + made,
                "lengths": np.array([len(c) for c in chars], dtype="<i8").tobytes(),
                "turns": b"".join(k.tobytes() for k in keys),
                "chars": b"".join(c.tobytes() for c in chars),
                "many": np.array(many, dtype="<i8").tobytes(),
                "least": np.array(least, dtype="<i8").tobytes(),
                "ends": list(ends),
                "before": before,
                "after": None,
                "head": keys[0].tobytes() if ready is None else None,
                "tail": None,
                "_first": keys[0],
                "_last": keys[-1],
            }

        for batch in batches:
            keys, chars = batch.column(0), batch.column(1)
            bounds = [c.offsets.to_numpy() for c in (keys, chars)]
            flat = [c.values.to_numpy() for c in (keys, chars)]
            rest = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            for i in range(len(batch)):
                # Copies, so that the batch can go.
                key, char = (f[b[i] : b[i + 1]].astype("<i8") for f, b in zip(flat, bounds))
                for column, value in zip(rows, (key, char, *(r[i] for r in rest))):
                    column.append(value)
                size += len(char) + 1
                if size > block_turns:
                    now = close()
                    if ready is not None:
                        yield batch_of(ready | {"after": now["before"]})
                    ready, rows, size, made = now, [[] for _ in range(5)], 0, made + 1
        if rows[0]:
            now = close()
            if ready is not None:
                yield batch_of(ready | {"after": now["before"]})
            ready = now
        if ready is not None:
            yield batch_of(ready | {"tail": ready["_last"].tobytes()})

    return sequences.select("key", "chars", "many", "least", "ends").mapInArrow(run, BLOCK)


def close_edges(blocks: DataFrame) -> DataFrame:
    """The blocks with ``before`` and ``after`` over the edges of range partitions, too; -1 at both ends of all."""
    edges: dict[int, dict] = {}
    for r in blocks.where("head is not null or tail is not null").select("part", "head", "tail").collect():  # two sequences per partition
        edge = edges.setdefault(r["part"], {})
        edge |= {k: np.frombuffer(r[k], "<i8") for k in ("head", "tail") if r[k] is not None}
    rows, parts = [], sorted(edges)
    shared = [-1, *(common_turns(edges[a]["tail"], edges[b]["head"]) for a, b in zip(parts, parts[1:])), -1]
    for i, part in enumerate(parts):
        rows.append({"part": part, "_before": shared[i], "_after": shared[i + 1]})
    table = literal_table(blocks.sparkSession, rows, "part int, _before int, _after int")
    both = blocks.join(F.broadcast(table), "part")  # one row of three numbers per range partition
    return both.withColumns({"before": F.coalesce("before", "_before"), "after": F.coalesce("after", "_after")}).drop("_before", "_after", "head", "tail")


def read_block(row: dict) -> tuple[Block, np.ndarray, np.ndarray]:
    """The block of a stored row, and the turns of its first and last sequence."""
    read = lambda name: np.frombuffer(row[name], "<i8")
    lengths, turns = read("lengths"), read("turns")
    block = Block(lengths, turns, read("chars"), read("many"), read("least"), row["before"], row["after"])
    return block, turns[: 2 * lengths[0]], turns[len(turns) - 2 * lengths[-1] :]


def crossing_members(blocks: DataFrame) -> DataFrame:
    """(block, side, depth, k1, k2, convs, least): the nodes over each block's edges and what the block has of them.

    Side 0 are nodes that reach in from the left, side 1 those that go on to the right; one that does both has a row for
    each, and only one of them counts.
    """
    names = ["block", "side", "depth", "k1", "k2", "convs", "least"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = PrefixDigests()
        for batch in batches:
            for row in batch.to_pylist():
                block, head, tail = read_block(row)
                convs, least = block.members()
                for side, which, turns in ((0, block.inherited, head), (1, block.reaches_on, tail)):
                    some = np.flatnonzero(which)
                    depth = block.depth[some]
                    k1, k2 = (k[depth] for k in digests.of(turns))
                    counts = np.where(block.inherited[some] if side else False, 0, convs[some])
                    sides = np.full(len(some), side, dtype=np.int32)
                    columns = [np.full(len(some), row["block"]), sides, depth, k1, k2, counts, least[some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = "block long, side int, depth long, k1 long, k2 long, convs long, least long"
    return blocks.drop("ends").mapInArrow(run, schema)


NODE = (
    "k1 long, k2 long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def block_nodes(blocks: DataFrame) -> DataFrame:
    """The nodes of each block; those without k1 are complete, the others hold the block's part of the sums.

    ``known0`` and ``known1`` are the settled (depth, convs, least) of the nodes over either edge.
    """
    names = [part.split()[0] for part in NODE.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = PrefixDigests()
        for batch in batches:
            for row in batch.to_pylist():
                block, head, tail = read_block(row)
                known = []
                for side in ("known0", "known1"):
                    by_depth = sorted((k["depth"], k["convs"], k["least"]) for k in row[side] or [])
                    known.append(tuple(np.array([k[c] for k in by_depth], dtype=np.int64) for c in (1, 2)))
                depth, least, parent, *sums = block.nodes(*known)
                keys = [np.zeros(len(depth), dtype=np.int64) for _ in range(2)]
                for which, turns in ((block.inherited, head), (block.reaches_on, tail)):
                    for key, digest in zip(keys, digests.of(turns)):
                        key[which] = digest[depth[which]]
                ends = np.full(len(depth), ENDS_NONE, dtype=object)
                whole = (depth == block.lengths[block.at]) & ~block.inherited
                ends[whole] = np.array(row["ends"], dtype=object)[block.at[whole]]
                ends[block.inherited] = None  # told where the node begins
                for a in range(0, len(depth), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    inner = ~block.crossing[part]
                    columns = [
                        *(pa.array(k[part], mask=inner) for k in keys),
                        pa.array(least[part]),
                        pa.array(depth[part]),
                        pa.array(parent[part], mask=depth[part] == 0),
                        *(pa.array(s[part]) for s in sums),
                        pa.array(ends[part], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.mapInArrow(run, NODE)


def ends_digests(convs: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """(key, ends): SHA-256 of the conv_ids with each key of (key, conv_id), ascending, in decimals joined by commas."""

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of the ids that follow each other in a range, with their first id."""
        held: list[tuple] = []  # (key, first, ids so far)

        def rows(parts: list[tuple]) -> pa.RecordBatch:
            keys, first, texts = zip(*parts)
            columns = [pa.array(keys, pa.binary()), pa.array(first, pa.int64()), pa.array([",".join(map(str, t)).encode() for t in texts], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "first", "text"])

        size = 0
        for batch in batches:
            for key, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not held or held[-1][0] != key or len(held[-1][2]) * 8 > chunk:
                    if size * 8 > chunk:
                        yield rows(held)
                        held, size = [], 0
                    held.append((key, conv_id, []))
                held[-1][2].append(conv_id)
                size += 1
        if held:
            yield rows(held)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        current, state = None, None
        done: tuple[list, list] = ([], [])
        take = lambda: pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], names=["key", "ends"])
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key == current:
                    state.update(b"," + text)
                    continue
                if state:
                    done[0].append(current)
                    done[1].append(state.hexdigest())
                current, state = key, sha256(text)
            if len(done[0]) > 1 << 14:
                yield take()
                done = ([], [])
        if state:
            done[0].append(current)
            done[1].append(state.hexdigest())
        if done[0]:
            yield take()

    # A key's ids are spread over ranges, so their texts are made in many tasks.
    spread = convs.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = spread.mapInArrow(join, "key binary, first long, text binary")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends string")


def prefix_trie(convs: DataFrame, block_turns: int = 1 << 18) -> DataFrame:
    """The nodes of the trie of (conv_id, turns): turns are arrays of structs with x, y and chars, in order."""
    both = F.flatten(F.transform("turns", lambda t: F.array(t["x"], t["y"])))
    rows = convs.select("conv_id", both.alias("key"), F.transform("turns", lambda t: t["chars"]).alias("chars"))
    # A name of 16 bytes for a sequence: the digest of its turns' digests.
    name = F.unhex(F.md5(F.array_join(F.transform("key", lambda v: v.cast("string")), ",")))
    rows = materialize(rows.withColumn("name", name), "trie-conversations")
    ends = ends_digests(rows.select(F.col("name").alias("key"), "conv_id")).withColumnRenamed("key", "name")
    sequences = rows.groupBy("name", "key", "chars").agg(F.count("*").alias("many"), F.min("conv_id").alias("least"))
    sequences = sequences.join(ends, "name").drop("name")
    sequences = materialize(sequences, "trie-sequences")
    ordered = sequences.repartitionByRange("key").sortWithinPartitions("key")
    blocks = close_edges(materialize(store_blocks(ordered, block_turns), "trie-blocks"))

    crossing = materialize(crossing_members(blocks), "trie-crossing")
    settled = crossing.groupBy("k1", "k2").agg(F.sum("convs").alias("convs"), F.min("least").alias("least"))
    back = crossing.select("block", "side", "depth", "k1", "k2").join(settled, ["k1", "k2"])
    side = lambda s: F.collect_list(F.when(F.col("side") == s, F.struct("depth", "convs", "least"))).alias(f"known{s}")
    back = back.groupBy("block").agg(side(0), side(1))
    nodes = materialize(block_nodes(blocks.join(back, "block", "left")), "trie-nodes")

    constant = ["conv_id", "depth", "parent_conv_id", "n_convs"]
    sums = ["n_children", "n_leaves", "saved_tokens"]
    parts = nodes.where("k1 is not null").groupBy("k1", "k2")
    merged = parts.agg(*(F.max(c).alias(c) for c in constant), *(F.sum(c).alias(c) for c in sums), F.max("ends_sha256").alias("ends_sha256"))
    columns = [*constant, *sums, "ends_sha256"]
    return nodes.where("k1 is null").select(*columns).unionByName(merged.select(*columns))

"""Prefix trie of conversations: what a cache of shared first turns would save.

Conversations are sorted by their sequence of turns and dealt to shards by sampled ranges of it, so
each shard holds one contiguous part of the trie. A shard writes its part as balanced
parentheses, one pair for each node in preorder. Blocks of the excess with their minima, in levels
of doubled width, answer ``findclose``, which delimits the subtree of a node; counts of ``()``
pairs give the leaves below it, and cumulative sums over the preorder its members and savings.

Only nodes on the first and the last path of a shard can have parts elsewhere. These spines go on
with what hangs off them already summed, and are merged by the same step over fewer shards, until
one shard holds them all.

Defined results: turns with no number come first, turns of one number stand in the order of the MD5
digest of role and text; repeated rows are turns of their own; a null role or text is
empty; rows without ``conv_id`` belong to no conversation and are left out; an empty table has no
conversation and so no node; other columns are ignored; texts of any length travel as digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, measured

#: Bytes of a turn in a path.
TURN = 16
#: Conversation ids of one range that are written as one piece of a list of ids.
ID_RANGE = 1 << 14
#: Nodes that one shard holds on average at most, and spines that one shard merges.
SHARD_NODES, SHARD_SPINES = 250_000, 4_000
#: Parentheses in the smallest block.
BLOCK = 64
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
#: Greater than every conversation id.
NO_ID = np.iinfo(np.int64).max

_PATHS = (
    "path binary, lengths array<bigint>, members array<bigint>, least array<bigint>, "
    "children array<bigint>, leaves array<bigint>, saved array<bigint>, ends array<string>"
)
_FOUND = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, _key binary, _up binary, "
    f"_spine struct<{_PATHS.replace(' ', ':').replace(',:', ',')}>"
)
_PER_NODE = ("members", "least", "children", "leaves", "saved")


class Parentheses:
    """Balanced parentheses of a trie with range min-max blocks of the excess."""

    def __init__(self, opens: np.ndarray):
        self.excess = np.cumsum(np.where(opens, 1, -1))
        width = -(-len(opens) // BLOCK) * BLOCK
        padded = np.full(max(width, BLOCK), np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.levels = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            if len(low) % 2:
                low = self.levels[-1] = np.append(low, np.iinfo(np.int64).max)
            self.levels.append(low.reshape(-1, 2).min(axis=1))

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Positions that close the parentheses opened at ``at``."""
        target = self.excess[at] - 1
        found = np.full(len(at), -1)
        self._scan(at + 1, target, np.arange(len(at)), found)
        rest = np.flatnonzero(found < 0)
        target = target[rest]
        # up and to the right until a block reaches the target, then down to its left-most part
        block, level = at[rest] // BLOCK + 1, np.zeros(len(rest), np.int64)
        going = np.ones(len(rest), bool)
        while going.any():
            for k, low in enumerate(self.levels):
                here = np.flatnonzero(going & (level == k))
                reached = low[block[here]] <= target[here]
                going[here[reached]] = False
                on = here[~reached]
                block[on] += 1
                up = on[block[on] % 2 == 0]
                block[up] //= 2
                level[up] += 1
        for k in range(len(self.levels) - 1, 0, -1):
            here = np.flatnonzero(level == k)
            left = 2 * block[here]
            first = self.levels[k - 1][left] <= target[here]
            block[here] = np.where(first, left, left + 1)
            level[here] -= 1
        self._scan(block * BLOCK, target, rest, found)
        return found

    def _scan(self, start: np.ndarray, target: np.ndarray, to: np.ndarray, found: np.ndarray) -> None:
        """Looks from ``start`` to the end of the block of the position asked for."""
        place = start.copy()
        going = np.flatnonzero(start < len(self.excess))
        while len(going):
            hit = self.excess[place[going]] == target[going]
            found[to[going[hit]]] = place[going[hit]]
            going = going[~hit]
            place[going] += 1
            at_end = (place[going] % BLOCK == 0) | (place[going] == len(self.excess))
            going = going[~at_end]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // TURN


class Shard:
    """One part of the trie from sorted paths with their values by depth."""

    def __init__(self, spines: bool, whole: bool):
        #: whether the paths are spines of other shards, and whether all paths are here
        self.spines, self.whole = spines, whole
        self.depth, self.length = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        self.bits, self.of = [np.ones(1, bool)], [np.zeros(1, np.int64)]
        self.count, self.stack = 1, np.zeros(1, np.int64)
        self.paths: list[bytes] = []
        self.at: list[np.ndarray] = []
        self.values: dict[str, list[list[int]]] = {c: [] for c in _PER_NODE}
        self.ends: dict[int, str] = {}

    def add(self, row: dict) -> None:
        path = row["path"]
        depth = len(path) // TURN
        common = _common(self.paths[-1], path) if self.paths else 0
        closed, opened = len(self.stack) - 1 - common, depth - common
        self.bits += [np.zeros(closed, bool), np.ones(opened, bool)]
        fresh = np.arange(self.count, self.count + opened)
        self.stack = np.concatenate([self.stack[: common + 1], fresh])
        self.depth.append(np.arange(common + 1, depth + 1))
        self.length.append(np.array(row["lengths"][common:], np.int64))
        self.of.append(np.full(opened, len(self.paths)))
        self.count += opened
        self.paths.append(path)
        # values stand at the end of the path, or at each of its nodes for a spine
        own = self.stack[depth + 1 - len(row["members"]) :]
        self.at.append(own)
        for c in _PER_NODE:
            self.values[c].append(row[c])
        for node, ends in zip(own.tolist(), row["ends"]):
            if ends is not None:
                self.ends[node] = ends

    def finish(self) -> Iterator[pa.RecordBatch]:
        """The finished nodes, then the spines."""
        n = self.count
        bits = np.concatenate([*self.bits, np.zeros(len(self.stack), bool)])
        opened = np.flatnonzero(bits)
        close = Parentheses(bits).findclose(opened)
        # nodes are numbered in preorder, so a subtree is a range of numbers
        end = (close + 1 - opened) // 2 + np.arange(n)
        leaf_pair = ~bits[opened + 1]
        depth, length = np.concatenate(self.depth), np.concatenate(self.length)
        of = np.concatenate(self.of)
        parent = _parents(depth)
        at = np.concatenate(self.at)
        own = {c: np.full(n, NO_ID if c == "least" else 0) for c in _PER_NODE}
        for c in _PER_NODE:
            joined = np.array([v for row in self.values[c] for v in row], np.int64)
            (np.minimum if c == "least" else np.add).at(own[c], at, joined)
        # nodes on the first and the last path may have parts in other shards
        spine = np.zeros(n, bool)
        first = np.arange(len(self.paths[0]) // TURN + 1)
        if not self.whole:
            spine[first] = True
            spine[self.stack] = True

        def below(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[end] - total[:n]

        members = below(own["members"])
        children = own["children"]
        np.add.at(children, parent[1:], ~spine[1:])
        leaves = below(own["leaves"] + (leaf_pair & (children == 0) & ~spine))
        saved = below(own["saved"] + np.where(spine, 0, (members - 1) * length))
        least = own["least"]
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)[:-1]:
            level = level[~spine[level]]
            np.minimum.at(least, parent[level], least[level])

        def key(node: int) -> bytes:
            return hashlib.md5(self.paths[of[node]][: TURN * int(depth[node])]).digest()

        keys = {k: key(k) for k in (range(n) if self.spines else np.flatnonzero(spine).tolist())}
        done = np.flatnonzero(~spine)
        for part in np.array_split(done, max(1, -(-len(done) // 50_000))):
            up = parent[part]
            # the parent's smallest member is only known once its spine is finished
            open_up = spine[up] & (depth[part] > 0)
            columns = [
                pa.array(least[part]),
                pa.array(depth[part]),
                pa.array(least[up], mask=open_up | (depth[part] == 0)),
                *(pa.array(v[part]) for v in (members, children, leaves, saved)),
                pa.array([self.ends.get(k, EMPTY_HASH) for k in part.tolist()], pa.string()),
                pa.array([keys.get(k) for k in part.tolist()], pa.binary()),
                pa.array(
                    [keys[k] if o else None for k, o in zip(up.tolist(), open_up)], pa.binary()
                ),
                pa.nulls(len(part), _FOUND_SCHEMA.field("_spine").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_FOUND_SCHEMA)
        if self.whole:
            return
        # a spine goes on with what hangs off its nodes: their ranges less those of spine nodes below
        hanging = {"members": members, "leaves": leaves, "saved": saved}
        on_spine = np.flatnonzero(spine)[1:]
        for c, v in hanging.items():
            rest = v.copy()
            np.subtract.at(rest, parent[on_spine], v[on_spine])
            hanging[c] = rest
        hanging |= {"children": children, "least": least}
        rows = []
        for path, nodes, skip in ((0, first, 0), (-1, self.stack, len(first))):
            if skip and len(self.paths) == 1:
                continue
            row = {"path": self.paths[path], "lengths": length[nodes[1:]].tolist()}
            known = nodes < skip
            for c in _PER_NODE:
                nothing = NO_ID if c == "least" else 0
                row[c] = np.where(known, nothing, hanging[c][nodes]).tolist()
            row["ends"] = [None if k < skip else self.ends.get(k) for k in nodes.tolist()]
            rows.append({"_spine": row})
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND_SCHEMA)


def _parents(depth: np.ndarray) -> np.ndarray:
    """Parent of each node of a preorder; the root is its own."""
    parent = np.zeros(len(depth), np.int64)
    order = np.argsort(depth, kind="stable")
    first = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(1, int(depth.max()) + 1):
        here, above = order[first[d] : first[d + 1]], order[first[d - 1] : first[d]]
        parent[here] = above[np.searchsorted(above, here) - 1]
    return parent


def _found_schema() -> pa.Schema:
    longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    spine = [("path", pa.binary()), ("lengths", longs), *((c, longs) for c in _PER_NODE), ("ends", texts)]
    numbers = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split()
    return pa.schema(
        [(c, pa.int64()) for c in numbers]
        + [("ends_sha256", pa.string()), ("_key", pa.binary()), ("_up", pa.binary())]
        + [("_spine", pa.struct(spine))]
    )


_FOUND_SCHEMA = _found_schema()


def _build(spines: bool, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(spines, whole)
        for batch in batches:
            for row in batch.to_pylist():
                shard.add(row)
        if shard.paths:
            yield from shard.finish()

    return run


def _list_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the sorted pieces of each path; the hash of its ids is fed piece by piece."""
    path, held, digest = None, None, None

    def row() -> pa.RecordBatch:
        one = {
            "path": path,
            "lengths": held["lengths"],
            "members": [held["n"]],
            "least": [held["least"]],
            **{c: [0] for c in ("children", "leaves", "saved")},
            "ends": [digest.hexdigest()],
        }
        return pa.RecordBatch.from_pylist([one], schema=pa.schema(list(_FOUND_SCHEMA.field("_spine").type)))

    for batch in batches:
        for found in batch.to_pylist():
            if held is None or found["path"] != path:
                if held is not None:
                    yield row()
                path, held, digest = found["path"], found, hashlib.sha256()
            else:
                held["n"] += found["n"]
                digest.update(b",")
            digest.update(found["ids"].encode())
    if held is not None:
        yield row()


def rebuilt(turns: DataFrame, shared: int = 6, block: int = 100) -> DataFrame:
    """Conversations that share first turns: (conv_id, turns of digest and length).

    Conversation c starts with the first ``h = crc32(c) % shared`` turns of conversation
    ``c - c % block`` and goes on with its own turns after its first h.
    """
    digest = F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"))
    own = (
        turns.filter(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .select("conv_id", F.struct("turn", digest.alias("d"), F.char_length("text").cast("long").alias("n")).alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .withColumn("turns", F.expr("transform(turns, t -> named_struct('d', t.d, 'n', t.n))"))
    )
    base = own.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, max(1, shared - 1)).alias("_first")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    joined = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % block, "_h": h}).join(
        base, "_base", "left"
    )
    rest = "slice(turns, _h + 1, greatest(size(turns) - _h, 0))"
    head = "if(_first IS NULL OR _h = 0, slice(turns, 1, 0), slice(_first, 1, _h))"
    return joined.select("conv_id", F.expr(f"concat({head}, {rest})").alias("turns"))


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, shard_spines: int = SHARD_SPINES) -> DataFrame:
    """One row per node of the trie over (conv_id, turns), as ``rebuilt`` gives them.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points of shared turns below) and ends_sha256 (of the sorted ids that end here).
    """
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = conversations.select(
        "conv_id",
        F.expr("unhex(array_join(turns.d, ''))").alias("path"),
        F.col("turns.n").alias("lengths"),
    )
    pieces = (
        placed.groupBy("path", F.floor(F.col("conv_id") / ID_RANGE).alias("_range"))
        .agg(
            F.first("lengths").alias("lengths"),
            F.count(F.lit(1)).alias("n"),
            F.min("conv_id").alias("least"),
            F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
        )
        .repartition(parts, "path")
        .sortWithinPartitions("path", "_range")
    )
    paths = materialize(pieces.mapInArrow(_list_ends, _PATHS), "trie-paths")
    nodes = paths.agg(F.sum(F.size("lengths") + 1).alias("n")).first()["n"] or 0
    shards = max(parts, -(-nodes // shard_nodes))
    found, spines = [], False
    while True:
        whole = spines and paths.count() <= shard_spines
        dealt = paths.coalesce(1) if whole else paths.repartitionByRange(shards, "path")
        built = dealt.sortWithinPartitions("path").mapInArrow(_build(spines, whole), _FOUND)
        built = materialize(built, "trie-nodes")
        found.append(built.filter("_spine IS NULL").drop("_spine"))
        if whole:
            break
        paths, spines = built.filter("_spine IS NOT NULL").select("_spine.*"), True
        shards = max(1, -(-paths.count() // shard_spines))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    keyed = every.filter("_key IS NOT NULL").select(F.col("_key").alias("_up"), F.col("conv_id").alias("_above"))
    return every.join(measured(keyed, "trie-spines"), "_up", "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )

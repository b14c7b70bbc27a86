"""Set similarity join on word shingles with prefix filters under several token orders.

Under any one order of all tokens, two sets with similarity ``t`` share a token among the
first ``n - ceil(t n) + 1`` of each. The join uses several orders:

* Equal sets are one class; only the representative goes on.
* Under each of some random orders, sets with the same first token meet in a bucket. Each is
  compared with the bucket's most typical member only, so a huge group of near copies costs
  one comparison for each member. These links give first components.
* Under three orders that put frequent tokens last (and differ within a frequency class), the
  prefixes are indexed. A candidate pair must share a prefix token under every order, lie in
  different first components, and pass the length and position filters. The next order
  is built only over texts that are still paired. What is left is compared exactly.

Frequency classes come from a bounded sample of ``sample_docs`` documents and at most
``max_ranked`` tokens. They only decide the order, so they change the cost and never the result.
A token of a frequent class is spread over block pairs.

Defined results: a text without words has no shingles and is linked with nothing; a text with
fewer words than a shingle has one; equal rows are linked; a null id is a document of its own,
and null is no smallest id unless all ids of a component are null; rows that share an id but
not a text are documents of their own; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import materialize, measured, slices
from zonewright.llm.components import components
from zonewright.llm.textkernel import batch_shingles, mix

_U = np.uint64
SIZE = 5
#: Orders whose first tokens are kept; the first BUCKETS of them form buckets.
HEADS, BUCKETS, AGREE = 8, 3, 4
#: Rows of one token and block that are expected at most before it is split further.
BLOCK = 4096
#: Blocks of one token at most.
BLOCKS = 1 << 12
#: Token orders whose prefixes are indexed; a candidate must pass each.
ORDERS = (0x3C6EF372, 0x1B873593, 0x5BD1E995)


class TokenRanks:
    """Frequency classes of the tokens that a sample holds often."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, scale: float):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]
        self.scale = scale

    def counts_of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)


def fit_ranks(
    docs: DataFrame, sample_docs: int = 30_000, least: int = 2, max_ranked: int = 1_000_000
) -> TokenRanks:
    """Counts of the tokens found in ``least`` or more of about ``sample_docs`` texts."""
    total = docs.count()
    share = min(1.0, sample_docs / max(1, total))
    chosen = docs.filter(
        F.pmod(F.xxhash64("_key", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                values, _ = batch_shingles(part.column("_text"), SIZE)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["token"])

    rows = (
        chosen.select("_text")
        .mapInArrow(run, "token bigint")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "token")
        .limit(max_ranked)
    )
    found = rows.toArrow()
    return TokenRanks(
        found["token"].to_numpy().view(_U), found["n"].to_numpy(), 1 / max(share, 1e-9)
    )


def _profile(ranks) -> object:
    seeds = [_U(0x51ED270B * (k + 1)) for k in range(HEADS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                values, offsets = batch_shingles(part.column("_text"), SIZE)
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes)
                rare = np.zeros(len(sizes), np.int64)
                sums = np.zeros((2, len(sizes)), _U)
                heads = np.zeros((HEADS, len(sizes)), _U)
                if len(full):
                    first = offsets[:-1][full]
                    unranked = (ranks.value.counts_of(values) == 0).astype(np.int64)
                    rare[full] = np.add.reduceat(unranked, first)
                    for k in range(2):
                        sums[k, full] = np.add.reduceat(mix(values ^ _U(0xABCD * (k + 7))), first)
                    for k, seed in enumerate(seeds):
                        heads[k, full] = np.minimum.reduceat(mix(values ^ seed), first)
                listed = pa.FixedSizeListArray.from_arrays(
                    pa.array(heads.T.ravel().view(np.int64)), HEADS
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"),
                        part.column("_key"),
                        pa.array(sizes),
                        pa.array(rare),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        listed.cast(pa.list_(pa.int64())),
                    ],
                    names=["id", "key", "n", "rare", "s1", "s2", "heads"],
                )

    return run


def _bucket_pairs(reps: DataFrame) -> DataFrame:
    """Each set with the most typical set of its buckets, if enough first tokens agree."""
    typical = F.struct((F.col("rare") / F.col("n")).alias("r"), "key", "n", "heads")
    out = None
    for k in range(BUCKETS):
        head = F.col("heads")[k]
        lead = (
            reps.groupBy(head.alias("head"))
            .agg(F.min(typical).alias("lead"), F.count(F.lit(1)).alias("m"))
            .filter("m > 1")
        )
        met = (
            reps.withColumn("head", head)
            .join(lead, "head")
            .filter("key <> lead.key")
            .filter(100 * F.least("n", "lead.n") >= 75 * F.greatest("n", "lead.n"))
            .filter(
                F.expr("size(filter(zip_with(heads, lead.heads, (x, y) -> x = y), z -> z))")
                >= AGREE
            )
            .select(
                F.least("key", "lead.key").alias("a"), F.greatest("key", "lead.key").alias("b")
            )
        )
        out = met if out is None else out.unionByName(met)
    return out.distinct()


def _verify(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets reach the similarity; only texts of some pair move."""
    wanted = measured(pairs, "pairs")
    one = docs.join(wanted, docs["_key"] == F.col("a")).select("a", "b", F.col("_text").alias("x"))
    two = docs.join(wanted, docs["_key"] == F.col("b")).select("a", "b", F.col("_text").alias("y"))
    # rows that share an id and a text share a key
    both = one.join(two, ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "x", 1 << 20):
                x, of_x = batch_shingles(part.column("x"), SIZE)
                y, of_y = batch_shingles(part.column("y"), SIZE)
                keep = []
                for i in range(part.num_rows):
                    p, q = x[of_x[i] : of_x[i + 1]], y[of_y[i] : of_y[i + 1]]
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * common >= percent * (len(p) + len(q) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(both.mapInArrow(run, "a bigint, b bigint").distinct(), "verified")


def _prefixes(ranks, seed: int, percent: int):
    """Prefix tokens of each set under one order, with size and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                values, offsets = batch_shingles(part.column("_text"), SIZE)
                sizes = np.diff(offsets)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                counts = table.counts_of(values)
                classes = np.ceil(np.log2(counts + 1)).astype(_U)
                place = (classes << _U(56)) | (mix(values ^ _U(seed)) >> _U(8))
                order = np.lexsort((place, owner))
                rank = np.arange(len(order)) - offsets[:-1][owner[order]]
                length = sizes - (percent * sizes + 99) // 100 + 1
                keep = rank < length[owner[order]]
                at, rank = order[keep], rank[keep]
                token, who, count = values[at].view(np.int64), owner[at], counts[at]
                key = part.column("_key").to_numpy()[who]
                label = part.column("_label").to_numpy()[who]
                # tokens expected in many sets are spread over pairs of blocks
                blocks = np.clip(np.ceil(count * table.scale / BLOCK), 1, BLOCKS).astype(np.int64)
                own = key % blocks
                copies = np.repeat(np.arange(len(at)), blocks)
                first = np.concatenate([[0], np.cumsum(blocks)[:-1]]) if len(at) else blocks
                other = np.arange(len(copies)) - np.repeat(first, blocks)
                low, high = np.minimum(own[copies], other), np.maximum(own[copies], other)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token[copies]),
                        pa.array((low * BLOCKS + high).astype(np.int32)),
                        pa.array(key[copies]),
                        pa.array(label[copies]),
                        pa.array(sizes[who][copies].astype(np.int32)),
                        pa.array(rank[copies].astype(np.int32)),
                    ],
                    names=["token", "block", "key", "label", "n", "rank"],
                )

    return run


def _passing(n1, r1, l1, n2, r2, l2, percent: int) -> np.ndarray:
    """Length and position filters between different first components."""
    left = np.minimum(n1 - r1, n2 - r2)
    return (
        (l1 != l2)
        & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))
        & ((100 + percent) * left >= percent * (n1 + n2))
    )


_INDEX = ("token", "block", "key", "label", "n", "rank")


def _groups(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Rows of an index sorted by token and block, with the first row and the end of each group.

    Holds one batch and the group that its last rows begin.
    """
    held: dict[str, np.ndarray] | None = None
    for batch in _ended(batches):
        if batch is not None:
            rows = {c: batch.column(c).to_numpy().astype(np.int64) for c in _INDEX}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in _INDEX}
        elif held is None:
            return
        else:
            rows = held
        token, block = rows["token"], rows["block"]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(fresh)
        ends = np.append(first[1:], len(token))
        if batch is not None:
            held = {c: v[first[-1] :].copy() for c, v in rows.items()}
            first, ends = first[:-1], ends[:-1]
        if len(first):
            yield rows, first, ends


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from (b for b in batches if b.num_rows)
    yield None


def _meet(percent: int):
    """Candidate pairs of one partition of the sorted index, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        waiting = 0

        def batch() -> pa.RecordBatch:
            nonlocal waiting
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), int)
            found.clear()
            waiting = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"]
            )

        for rows, first, ends in _groups(batches):
            key, label, n, rank = (rows[c] for c in ("key", "label", "n", "rank"))
            inside = label[: ends[-1]]
            mixed = np.minimum.reduceat(inside, first) != np.maximum.reduceat(inside, first)
            first, ends = first[mixed], ends[mixed]

            def met(i: np.ndarray, j: np.ndarray) -> None:
                nonlocal waiting
                ok = _passing(n[i], rank[i], label[i], n[j], rank[j], label[j], percent)
                pair = np.stack([key[i[ok]], key[j[ok]]], axis=1)
                found.append(np.sort(pair, axis=1))
                waiting += len(pair)

            two = first[ends - first == 2]
            met(two, two + 1)
            for start, end in zip(first.tolist(), ends.tolist()):
                size = end - start
                if size == 2:
                    continue
                if size <= 256:
                    i, j = np.triu_indices(size, 1)
                    met(start + i, start + j)
                else:
                    for i in range(start, end - 1):
                        j = np.arange(i + 1, end)
                        met(np.full(len(j), i), j)
                        if waiting > 200_000:
                            yield batch()
                if waiting > 200_000:
                    yield batch()
        yield batch()

    return run


def candidates(docs: DataFrame, ranks, seed: int, percent: int, name: str) -> DataFrame:
    """Pairs that share a prefix token under the order of ``seed``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = docs.select("_key", "_label", "_text").mapInArrow(
        _prefixes(ranks, seed, percent),
        "token bigint, block int, key bigint, label bigint, n int, rank int",
    )
    return materialize(
        index.repartition(parts, "token", "block")
        .sortWithinPartitions("token", "block")
        .mapInArrow(_meet(percent), "a bigint, b bigint")
        .distinct(),
        name,
    )


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 75,
    sample_docs: int = 30_000,
    keys: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``.

    With ``keys`` also ``row_key``, the xxhash64 of id and text, and ``component_key``, alike for all
    rows of a component and for no others: both tell rows apart that share an id.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(F.col(id_col), text).alias("_key"),
        text.alias("_text"),
    )
    ranks = spark.sparkContext.broadcast(fit_ranks(keyed, sample_docs))
    profile = materialize(
        keyed.mapInArrow(
            _profile(ranks),
            "id bigint, key bigint, n bigint, rare bigint, s1 bigint, s2 bigint, "
            "heads array<bigint>",
        ),
        "set-profiles",
    )
    same = ["n", "s1", "s2"]
    filled = profile.filter("n > 0")
    classes = materialize(
        filled.groupBy(*same).agg(
            F.min(F.struct("key", "rare", "heads")).alias("rep")
        ),
        "set-classes",
    )
    reps = classes.select("rep.*", "n")
    first_links = _verify(_bucket_pairs(reps), keyed, percent)
    first = materialize(components(first_links), "first-components")
    # one text per class goes on, with its first component
    others = (
        filled.select("key", *same)
        .join(classes.select(*same, F.col("rep.key").alias("rep")), same)
        .filter("key <> rep")
        .select("key", F.lit(None).cast("long").alias("label"))
    )
    empty = profile.filter("n = 0").select("key", F.lit(None).cast("long").alias("label"))
    roles = measured(
        first.select(F.col("node").alias("key"), "label")
        .unionByName(others)
        .unionByName(empty)
        .distinct(),
        "set-roles",
    )
    alone = (
        keyed.join(roles, keyed["_key"] == roles["key"], "left")
        .filter("key IS NULL OR label IS NOT NULL")
        .select("_key", "_text", F.coalesce("label", "_key").alias("_label"))
    )
    pairs = None
    for number, seed in enumerate(ORDERS):
        found = candidates(alone, ranks, seed, percent, f"pairs-order-{number}")
        pairs = found if pairs is None else materialize(pairs.join(found, ["a", "b"]), "pairs-met")
        # the next order is built only over texts that are still paired
        involved = measured(
            pairs.select(F.explode(F.array("a", "b")).alias("_key")).distinct(), "paired-sets"
        )
        alone = alone.join(involved, "_key", "left_semi")
    late_links = _verify(pairs, keyed, percent)
    labels = components(first_links.unionByName(late_links))
    ranks.unpersist()
    grouped = (
        classes.select(*same, F.col("rep.key").alias("node"))
        .join(labels, "node", "left")
        .select(*same, F.coalesce("label", "node").alias("label"))
    )
    placed = profile.select("id", "key", *same).join(grouped, same, "left")
    placed = materialize(placed, "set-labels")
    least = placed.filter("n > 0").groupBy("label").agg(F.min("id").alias("low"))
    more = [F.col("key").alias("row_key"), F.coalesce("label", "key").alias("component_key")]
    return placed.join(least, "label", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("id")).alias("component_id"),
        *(more if keys else []),
    )

"""SimHash near-duplicates, linked through vantage-point trees.

Fingerprints: one bit for each position that more than half of a text's shingle hashes have set. Equal fingerprints
are one point from then on, under the smallest doc_id.

Points within RADIUS bits are found exactly. The 64 bits are cut into BLOCKS; if two points differ in 4 bits or fewer,
they differ in one bit or none in the first of four blocks, or in none of another: radii whose sum, with one added to
each, is above RADIUS. Each block has a routing tree, fitted on a bounded sample, that halves the block's space again
and again at the median Hamming distance from a vantage point; its leaves are the shards. A point belongs to one leaf of
each tree. Where its distance is within the block's radius of the border, the triangle inequality leaves the other side
open, and a copy of the point also queries there; elsewhere the side is pruned, with radius 0 always. Copies go to
leaves of higher number only, so each pair of shards meets once. (One tree over all 64 bits is exact as well, but with
radius 4 two thirds of the points cross each border: copies grow with the power 1.75 of the points. By blocks they grow
in proportion, but for the first block's.)

Beyond TREE_POINTS points a block has too few values for shards of a bounded size. Then shards go by several blocks that
are equal: of 6 blocks any 2, of 7 any 3, and so on, with as many bits as the points ask for.

Within a shard a vantage-point tree over all 64 bits of its own points answers all queries together, pruned by the same
bounds, down to leaves that are compared bit by bit.

A shard returns each connected point with the least id that it reaches there, never its pairs, so a dense group of n
points gives n rows. Components over all shards are then joined by star contraction.

Null and empty texts have no words: fingerprint zero, linked like any other. Texts of any length are hashed whole. Rows
without a doc_id take part with the others (a group without any id has a null component); repeated rows are exact
copies; the sample is taken by a hash, ties by the fingerprint itself; empty tables give empty results; other columns
aren't read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import materialise, right_sized, text_key, trimmed, trimmed_group
from quillstream.llm.graph import connected_components

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCKS = 4
SHARD_POINTS = 8192
#: Points beyond which a block's 16 bits leave shards too large, and shards go by several equal blocks.
TREE_POINTS = 2**27
SAMPLE = 20_000
LEAF = 48
#: Comparisons made at once.
BLOCK = 2_000_000


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    counts = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(bits), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: A-Z in lower case, words between ASCII blanks, shingles of `size` words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= size:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate([len(w) + 1 for w in words]))
    hashes = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1 :])]
    return majority(np.array(hashes, np.uint64))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of each row; keyed: also text_key."""
    names = ["doc_id", "fp", *["text_key"] * keyed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.array([fingerprint(t, size) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(found.view(np.int64)), *part.columns[2:]], names=names)

    return docs.select(key, text, *[text_key(text).alias("text_key")] * keyed).mapInArrow(trimmed(run), ", ".join(f"{n} long" for n in names))


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """Vantage-point tree; a node is (vantage point, median distance, near child, far child), a leaf its number."""

    def __init__(self, points: np.ndarray, depth: int, leaf: int, seed: int = 0) -> None:
        self.nodes: list[tuple] = []
        self.leaves: list[np.ndarray] = []
        self.random = np.random.default_rng(seed)
        self.root = self._build(points, np.arange(len(points)), depth, leaf)

    def _build(self, points: np.ndarray, own: np.ndarray, depth: int, leaf: int) -> tuple:
        if depth and len(own) > leaf:
            tried = points[self.random.choice(own, min(5, len(own)), replace=False)]
            some = points[own[:: max(1, len(own) // 256)]]
            vantage = max(tried, key=lambda v: distance(some, v).std())
            d = distance(points[own], vantage)
            middle = int(np.median(d))
            near = d <= middle
            if near.all():
                middle -= 1
                near = d <= middle
            if near.any() and not near.all():
                return (vantage, middle, self._build(points, own[near], depth - 1, leaf), self._build(points, own[~near], depth - 1, leaf))
        self.leaves.append(own)
        return (len(self.leaves) - 1,)

    def visits(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, indices of the points that have to look there, which of these belong there)."""
        waiting = [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while waiting:
            node, who, own = waiting.pop()
            if not len(who):
                continue
            if len(node) == 1:
                yield node[0], who, own
                continue
            vantage, middle, near, far = node
            d = distance(points[who], vantage).astype(np.int16)
            here = d - radius <= middle
            waiting.append((near, who[here], own[here] & (d[here] <= middle)))
            here = d + radius > middle
            waiting.append((far, who[here], own[here] & (d[here] > middle)))


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the sets of a[i] and b[i]; parent[i] is the least index of i's set before and after."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def linked(points: np.ndarray, own: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Least index that each point reaches over links to points that belong here (`own`)."""
    parent = np.arange(len(points))
    mine = np.flatnonzero(own)
    if not len(mine):
        return parent
    tree = Tree(points[mine], 64, LEAF)
    for leaf, who, _ in tree.visits(points, radius):
        there = mine[tree.leaves[leaf]]
        step = max(1, BLOCK // len(there))
        for at in range(0, len(who), step):
            asking = who[at : at + step]
            i, j = np.nonzero(distance(points[asking][:, None], points[there][None, :]) <= radius)
            parent = merge(parent, asking[i], there[j])
    return parent


def block_radii(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Radii of the blocks: points within `radius` are within it in one block at least. -1: the block isn't needed."""
    return [(radius + 1) // blocks - 1 + (i < (radius + 1) % blocks) for i in range(blocks)]


def block_widths(blocks: int = BLOCKS) -> list[int]:
    """Bits of each block."""
    at = [64 * i // blocks for i in range(blocks + 1)]
    return [b - a for a, b in zip(at, at[1:])]


def block_values(fp: np.ndarray, blocks: int = BLOCKS) -> list[np.ndarray]:
    """The bits of each block."""
    at = [64 * i // blocks for i in range(blocks + 1)]
    return [(fp >> np.uint64(a)) & np.uint64(2 ** (b - a) - 1) for a, b in zip(at, at[1:])]


def masks(n: int, radius: int, shard_points: int) -> list[np.uint64]:
    """Bits in which points within `radius` agree for one mask at least, so many that a shard of n points has about `shard_points`: of b blocks, any b - radius."""
    for b in range(radius + 2, 33):
        k = b - radius
        if n >> min(63, 64 * k // b) <= shard_points:
            break
    at = [64 * i // b for i in range(b + 1)]
    block = [(1 << hi) - (1 << lo) for lo, hi in zip(at, at[1:])]
    return [np.uint64(sum(block[i] for i in c)) for c in itertools.combinations(range(b), k)]


def links(points: DataFrame, radius: int = RADIUS, shard_points: int = SHARD_POINTS, blocks: int = BLOCKS) -> DataFrame:
    """points (fp, id): distinct fingerprints -> edges (a, b) that connect exactly those within `radius` over any steps."""
    n = points.count()
    by_masks = masks(n, radius, shard_points) if n > TREE_POINTS else []
    depth = 0 if by_masks else max(0, int(np.ceil(np.log2(max(1, n) / shard_points))))
    sample = points.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(np.int64).view(np.uint64) if depth else np.zeros(0, np.uint64)
    values = [np.unique(v) for v in block_values(sample, blocks)]
    if depth > np.log2(SAMPLE / 4):  # more leaves than the sample can tell apart: fitted on each block's whole space
        values = [np.arange(min(2**16, 2 ** int(w)), dtype=np.uint64) << np.uint64(max(0, int(w) - 16)) for w in block_widths(blocks)]
    routers = [(r, Tree(v, depth, 1)) for r, v in zip(block_radii(radius, blocks), values, strict=True)]
    first_leaf = np.cumsum([0, *[len(t.leaves) for _, t in routers]])
    if not depth:  # one shard, one tree
        routers = [(radius, routers[0][1]), *[(-1, t) for _, t in routers[1:]]]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            for i, mask in enumerate(by_masks):  # shards that get one number are compared together
                shard = (fp & mask) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i) * np.uint64(0xC2B2AE3D27D4EB4F)
                yield pa.RecordBatch.from_arrays([pa.array(shard.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(ids), pa.array(np.ones(len(fp), bool))], names=["shard", "fp", "id", "own"])
            for block, (values, (reach, router)) in enumerate(zip(block_values(fp, blocks), routers, strict=True)):
                if reach < 0 or by_masks:
                    continue
                seen = list(router.visits(values, reach))
                home = np.zeros(len(fp), np.int32)
                for leaf, who, own in seen:
                    home[who[own]] = leaf
                for leaf, who, own in seen:
                    keep = own | (home[who] < leaf)
                    who, own = who[keep], own[keep]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(who), first_leaf[block] + leaf, np.int64)), pa.array(fp[who].view(np.int64)), pa.array(ids[who]), pa.array(own)], names=["shard", "fp", "id", "own"]
                    )

    def connect(shard: pa.Table) -> pa.Table:
        shard = shard.combine_chunks()
        ids = shard.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")  # so the least index is the least id
        ids = ids[order]
        least = linked(shard.column("fp").to_numpy()[order].view(np.uint64), shard.column("own").to_numpy()[order], radius)
        moved = np.flatnonzero(least != np.arange(len(ids)))
        return pa.table({"a": ids[moved], "b": ids[least[moved]]})

    routed = points.select("fp", "id").mapInArrow(trimmed(route), "shard long, fp long, id long, own boolean")
    return routed.groupBy("shard").applyInArrow(trimmed_group(connect), "a long, b long")


def grouped_points(prints: DataFrame, radius: int, shard_points: int) -> DataFrame:
    """fp, least (doc_id), group of each distinct fingerprint: links connect two fingerprints if and only if their groups are equal. Fingerprints themselves name points and groups, so that rows need no ids."""
    points = materialise(right_sized(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("id", F.col("fp")), prints), "points")
    found = connected_components(links(points, radius, shard_points))
    return points.join(found, "id", "left").select("fp", "least", F.coalesce("component", "fp").alias("group"))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, size: int = SHINGLE, shard_points: int = SHARD_POINTS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable, itself included) of each row."""
    prints = materialise(fingerprints(docs, key, text, size), "fingerprints")
    points = materialise(right_sized(grouped_points(prints, radius, shard_points), prints), "grouped-points")
    joined = points.join(points.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("fp", "component_id")
    return right_sized(prints.join(joined, "fp").select("doc_id", "fp", "component_id"), prints)


def row_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, size: int = SHINGLE, shard_points: int = SHARD_POINTS) -> DataFrame:
    """doc_id, text_key, group of each row: rows have one group if and only if links connect their fingerprints, whatever their ids."""
    prints = materialise(fingerprints(docs, key, text, size, keyed=True), "fingerprints")
    joined = grouped_points(prints, radius, shard_points).select("fp", "group")
    return right_sized(prints.join(joined, "fp").select("doc_id", "text_key", "group"), prints)


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))

"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

Fingerprints: a bit is set if it is set in over half of the document's shingle hashes.

Links: two fingerprints at most ``distance`` bits apart agree on all but ``distance`` of the
``distance + 4`` blocks the bits are cut into. Each distinct fingerprint is therefore routed
under every choice of agreeing blocks, with these blocks' bits as the key; partners meet under
at least one. A group of one key holds distinct fingerprints that differ only in the other
blocks (22 bits at distance 2), which bounds it however many documents there are. Inside its
group a fingerprint is found by the index: members in Gray order, runs of eight factored into
nodes that keep the bit pattern all members share, a node storing only the bits its parent does
not. A query accumulates differing bits on the way down and leaves whole nodes as soon as they
exceed the distance; a node that cannot exceed it is taken whole.
"""

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, restored, shielded
from .components import components

_FANOUT = 8
_SLICE = 1 << 16
_ONE = np.uint64(1)


# --- fingerprints ----------------------------------------------------------------------


def fingerprint(data: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text; 0 without words."""
    found = (data or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    breaks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], breaks + 1)).tolist()
    ends = np.concatenate((breaks, [len(joined)])).tolist()[min(shingle, len(found)) - 1 :]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), _SLICE):
        spans = zip(starts[at : at + _SLICE], ends[at : at + _SLICE])
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * total > len(ends), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a long of the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        prints = [fingerprint(x, shingle, seed) for x in texts]
        return pd.Series(np.array(prints, np.uint64).view(np.int64))

    return of(text.cast("binary"))


# --- index -----------------------------------------------------------------------------


def block_masks(distance: int) -> list[int]:
    """The masks of the blocks that may agree, one for each choice of blocks."""
    blocks = distance + 4
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(single, blocks - distance)]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected binary sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Level:
    """Nodes of one level over members sorted by group and Gray rank."""

    def __init__(self, first: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.first = first  # first child in the level below, one entry more than nodes
        self.low, self.high = low, high  # conjunction and disjunction of the members
        self.shared = ~(low ^ high)
        self.own = self.shared  # less what the parent stores
        self.begin = self.end = None  # members


def _levels(prints: np.ndarray, group_first: np.ndarray) -> list[_Level]:
    """Bottom-up, until each group is one node; group_first has one entry more than groups."""
    leaf = _Level(np.arange(len(prints) + 1), prints, prints)
    leaf.begin, leaf.end = leaf.first[:-1], leaf.first[1:]
    levels, starts = [leaf], group_first
    while len(starts) - 1 < len(levels[-1].low):
        below = levels[-1]
        sizes = np.diff(starts)
        nodes = -(-sizes // _FANOUT)
        group = np.repeat(np.arange(len(sizes)), nodes)
        ahead = np.concatenate(([0], np.cumsum(nodes)))
        inside = np.arange(len(group)) - ahead[group]
        first = np.append(starts[group] + inside * _FANOUT, starts[-1])
        level = _Level(
            first,
            np.bitwise_and.reduceat(below.low, first[:-1]),
            np.bitwise_or.reduceat(below.high, first[:-1]),
        )
        level.begin, level.end = below.begin[first[:-1]], below.end[first[1:] - 1]
        below.own = below.shared & ~np.repeat(level.shared, np.diff(first))
        levels.append(level)
        starts = ahead
    return levels


class Forest:
    """Labels of nodes 0..n-1 under unions given as arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.label[a], self.label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while (next_ := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = next_


def _expand(first: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes, and for each child the position of its parent in ``nodes``."""
    sizes = first[nodes + 1] - first[nodes]
    parent = np.repeat(np.arange(len(nodes)), sizes)
    offset = np.arange(len(parent)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return first[nodes][parent] + offset, parent


def link_groups(prints: np.ndarray, group: np.ndarray, mask: np.ndarray, distance: int):
    """Edges (two arrays of prints) that connect each group as all its links would.

    ``group`` is sorted and numbers the groups; ``mask`` has for each print the bits its group
    agrees on. Groups of one print have no links.
    """
    sizes = np.bincount(group)
    alone = sizes[group] < 2
    prints, group, mask = prints[~alone], group[~alone], mask[~alone]
    if not len(prints):
        return prints, prints
    order = np.lexsort((gray_rank(prints & ~mask), group))
    prints, group = prints[order], group[order]
    group_first = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(prints))
    levels = _levels(prints, group_first)
    top, forest = len(levels) - 1, Forest(len(prints))
    whole: list[tuple[np.ndarray, np.ndarray]] = []
    found_a, found_b, pending = [], [], 0

    def flush() -> None:
        nonlocal pending
        if found_a:
            forest.union(np.concatenate(found_a), np.concatenate(found_b))
            found_a.clear(), found_b.clear()
        pending = 0

    roots = np.repeat(np.arange(len(group_first) - 1), np.diff(group_first))
    stack = [
        (top, np.arange(a, min(a + _SLICE, len(prints))), roots[a : a + _SLICE])
        for a in range(0, len(prints), _SLICE)
    ]
    stack = [(k, q, node, np.zeros(len(q), np.int64)) for k, q, node in stack]
    while stack:
        k, query, node, acc = stack.pop()
        if len(query) > _SLICE:
            stack += [
                (k, query[i : i + _SLICE], node[i : i + _SLICE], acc[i : i + _SLICE])
                for i in range(0, len(query), _SLICE)
            ]
            continue
        level = levels[k]
        acc = acc + np.bitwise_count((prints[query] ^ level.low[node]) & level.own[node])
        ahead = (acc <= distance) & (level.end[node] - 1 > query)
        query, node, acc = query[ahead], node[ahead], acc[ahead]
        sure = acc + np.bitwise_count(~level.shared[node]) <= distance
        if sure.any():
            found_a.append(query[sure])
            found_b.append(level.begin[node[sure]])
            pending += int(sure.sum())
            taken = np.unique(node[sure])
            whole.append((level.begin[taken], level.end[taken]))
            query, node, acc = query[~sure], node[~sure], acc[~sure]
        if len(query) and k:
            child, parent = _expand(level.first, node)
            stack.append((k - 1, query[parent], child, acc[parent]))
        if pending > 1 << 20:
            flush()
    flush()
    for begin, end in whole:
        for at in range(0, len(begin), _SLICE):
            a, b = begin[at : at + _SLICE], end[at : at + _SLICE]
            size = b - a
            head = np.repeat(a, size)
            inside = np.arange(len(head)) - np.repeat(np.cumsum(size) - size, size)
            forest.union(head, head + inside)
    tied = np.flatnonzero(forest.label != np.arange(len(prints)))
    return prints[tied], prints[forest.label[tied]]


def _edges_of(distance: int, rows: int):
    """Batches sorted by (choice, key) to edges; groups are never split between blocks."""
    masks = np.array(block_masks(distance), np.uint64)

    def linked(choice: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        mask = masks[choice]
        key = prints & mask
        fresh = np.ones(len(prints), bool)
        fresh[1:] = (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])
        a, b = link_groups(prints, np.cumsum(fresh) - 1, mask, distance)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"]
        )

    def run(parts):
        held, size, limit = [], 0, rows
        for part in parts:
            held.append((part.column(0).to_numpy(), part.column(1).to_numpy().view(np.uint64)))
            size += part.num_rows
            if size < limit:
                continue
            choice, prints = (np.concatenate(x) for x in zip(*held))
            key = prints & masks[choice]
            others = np.flatnonzero((choice != choice[-1]) | (key != key[-1]))
            if len(others):  # all but the last group is complete
                done = others[-1] + 1
                yield linked(choice[:done], prints[:done])
                choice, prints = choice[done:], prints[done:]
            held, size = [(choice, prints)], len(prints)
            limit = max(rows, 2 * size)
        if size:
            yield linked(*(np.concatenate(x) for x in zip(*held)))

    return run


def link(prints: DataFrame, *, distance: int = 2) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all within the distance.

    ``prints`` has one column ``fp`` (long) of distinct values. An edge joins fingerprints of
    one component, but only enough of them are returned to hold it together.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(distance)]
    routes = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks)
        ])
    )
    routed = prints.select("fp", routes.alias("r")).select("r.choice", "fp", "r.key")
    ordered = routed.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return ordered.select("choice", "fp").mapInArrow(_edges_of(distance, 1 << 18), "u long, v long")


# --- operator --------------------------------------------------------------------------


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) of the fingerprinted documents (doc_id, fp)."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("doc")))
    tied = components(link(distinct.select("fp"), distance=distance))
    known = distinct.join(tied.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = known.select("fp", "doc", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 2,
) -> DataFrame:
    """One row per document: ``key``, ``fp`` (long), ``fingerprint`` (hex), ``component_id``.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows
    each return a row. A null key takes no part in the least key of its component, which is
    null if no document of it has a key. Other columns of the input are not read.
    """
    batches(docs.sparkSession, 1024)
    prints = cut(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"),
            fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp"),
        )
    )
    return prints.join(_classes(prints, distance), "fp").select(
        F.col("doc_id").alias(key),
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b"")))


_IDENTITY = ["_key", "_keyless", "_text"]


def _identity(key: Column, text_hash: Column) -> list[Column]:
    """What tells rows apart, without nulls."""
    parts = (F.coalesce(key.cast("string"), F.lit("")), key.isNull(), text_hash)
    return [part.alias(name) for name, part in zip(_IDENTITY, parts)]


def keep_first(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """One document of each component, that with the least key, in the input's columns.

    Of rows that repeat the least key of a component, one is kept; so is one document without
    a key if its component has no key at all.
    """
    batches(docs.sparkSession, 1024)
    prints = cut(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"),
            _text_hash(F.col(f"`{text}`")).alias("text_hash"),
            fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp"),
        )
    )
    first = (
        prints.join(_classes(prints, distance), "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id")
        .agg(F.min("text_hash").alias("text_hash"))
    )
    first = first.select(*_identity(F.col("doc_id"), F.col("text_hash")))
    inner, name = shielded(docs)
    tagged = inner.select("*", *_identity(F.col(name[key]), _text_hash(F.col(name[text]))))
    # Joined and counted by the same columns: the texts are shuffled once.
    kept = tagged.join(first, _IDENTITY, "left_semi").dropDuplicates(_IDENTITY)
    return restored(kept, name)

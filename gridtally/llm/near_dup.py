"""Near-duplicate documents by MinHash with tensored banding, every link confirmed on full sets.

A table key of banded MinHash joins k minhashes, so L tables cost k * L of them. Here two small
collections of `rows` tuples are computed, and each pair of one tuple from either is a key:
`rows`**2 tables from 2 * `rows` tuples, about the square root of the minhashes. A pair of
documents is a candidate if any of their keys agree; at similarity s that fails with a probability
of about 2 * (1 - s**2)**rows, 0.0002 at 0.8 with nine rows of two hashes, and less above.

Documents with equal sets are one node from the start, so copies are never compared. Within a key
all nodes are compared with one of them, the pivot, which then leaves the key; as long as the others
there are of different components, another of them is the pivot. So small keys end with all their pairs
compared, and a large group of near copies grows together around a few pivots. Nodes of keys that still
hold different components after a few rounds go through an exact prefix-filter join, which finds every
link left between them without comparing all with all. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.cluster import Workspace, in_parts, ship, with_group
from gridtally.llm.sketches import cell_levels
from gridtally.llm.words import Words, mixed, slices

#: Rounds of comparisons with pivots; what they leave open goes through the exact join.
_PIVOTS = 3
#: Cells in the table of hashed shingle counts are 2 to this power at most.
_MOST_BITS = 22
#: Rows of a frequent shingle that one task compares with the others.
_PIECE = 512

_SIGNATURE = "n_shingles long, set_low long, set_high long, left array<long>, right array<long>"


def _distinct(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of each distinct shingle, sorted by both; short texts are one shingle."""
    at, rows, _ = words.windows(length)
    values = words.window_values(at, length)
    short = np.flatnonzero((words.counts > 0) & (words.counts < length))
    if len(short):
        whole = words.window_values(words.begins()[short], words.counts[short], seed=1)
        rows, values = np.concatenate((rows, short)), np.concatenate((values, whole))
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def _sum_by(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return np.diff(total[np.searchsorted(rows, np.arange(n + 1))])


def _signatures(length: int, rows_each: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mixed(np.arange(1, 2 * rows_each * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            for words in slices(batch.column("text"), lower=True):
                n = len(words.counts)
                rows, values = _distinct(words, length)
                sizes = np.bincount(rows, minlength=n)
                some = np.flatnonzero(sizes)
                begins = np.searchsorted(rows, some)
                tuples = np.zeros((n, 2 * rows_each), dtype=np.uint64)
                for k, salt in enumerate(salts):
                    if len(some):
                        least = np.minimum.reduceat((values ^ salt) * (salt | np.uint64(1)), begins)
                        column = tuples[some, k // hashes]
                        tuples[some, k // hashes] = mixed(column * np.uint64(31) + least + np.uint64(1))
                parts.append([sizes, _sum_by(rows, values, n), _sum_by(rows, mixed(values), n), tuples])
            if not parts:
                continue
            sizes, low, high, tuples = (np.concatenate(x) for x in zip(*parts, strict=True))
            ends = pa.array(np.arange(len(sizes) + 1) * rows_each, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    pa.ListArray.from_arrays(ends, np.ascontiguousarray(tuples[:, :rows_each]).view(np.int64).ravel()),
                    pa.ListArray.from_arrays(ends, np.ascontiguousarray(tuples[:, rows_each:]).view(np.int64).ravel()),
                ],
                ["doc_id", "n_shingles", "set_low", "set_high", "left", "right"],
            )

    return run


def _shingle_sets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column("text"), lower=True):
                n = len(words.counts)
                rows, values = _distinct(words, length)
                cuts = (np.searchsorted(rows, np.arange(n + 1)) * 8).astype(np.int32)
                sets = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(words.first, n), sets], ["node", "shingles"]
                )

    return run


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common, united = [], []
        for one, other in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, other))
            if len(x) > len(y):
                x, y = y, x
            place = np.searchsorted(y, x)
            place[place == len(y)] = 0
            both = int(np.count_nonzero(y[place] == x)) if len(y) else 0
            common.append(both)
            united.append(len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(united, pa.int64())],
            ["a", "b", "common", "united"],
        )


def components(
    space: Workspace, links: DataFrame, name: str = "component", known: DataFrame | None = None
) -> DataFrame:
    """(node, component) of every node of `links` (a, b); component is the smallest node reachable.

    `known` is the result for links found before, which is carried on: only what `links` joins of its
    components is worked on. Each round hooks every node to its smallest neighbour, follows these pointers twice, and
    contracts the links; the links left shrink at least by half. Links and labels stay on the
    cluster, written after each round in as few parts as their rows need.
    """
    count = F.count(F.lit(1))
    edges = links.select("a", "b")
    if known is not None:
        for end in ("a", "b"):
            edges = edges.join(known.withColumnRenamed("node", end), end, "left")
            edges = edges.withColumn(end, F.coalesce("component", end)).drop("component")
    edges, n = space.keep_with(edges.select("a", "b").where("a <> b").distinct(), f"{name}-edges-0", count)
    labels: DataFrame | None = None
    step = nodes = 0
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        hook = in_parts(hook.select("node", F.least("node", "to").alias("to")), 2 * n)
        hook, hooks = space.keep_with(hook, f"{name}-hook-{step}", count)
        nodes = nodes or hooks
        for again in range(2):
            after = hook.select(F.col("node").alias("to"), F.col("to").alias("further"))
            hook = hook.join(after, "to").select("node", F.col("further").alias("to"))
        hook = space.keep(in_parts(hook, hooks), f"{name}-jump-{step}")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            moved = hook.select(F.col("node").alias("component"), "to")
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
            labels = space.keep(in_parts(labels, nodes), f"{name}-labels-{step}")
        for end in ("a", "b"):
            edges = edges.join(hook.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        step += 1
        edges = in_parts(edges.select("a", "b").where("a <> b").distinct(), n)
        edges, n = space.keep_with(edges, f"{name}-edges-{step}", count)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) if known is None else known
    if known is None:
        return labels
    moved = labels.select(F.col("node").alias("component"), F.col("component").alias("to"))
    old = known.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = labels.join(known.select("node"), "node", "left_anti")
    return space.keep(old.unionByName(new), f"{name}-all")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    rows: int = 9,
    hashes: int = 2,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs` (doc_id, text).

    Words are runs of other bytes than the six ASCII white-space characters, A-Z lower-cased. A
    document's set holds its distinct shingles of `shingle_words` words, or its whole sequence if it
    has fewer words. Documents are linked if 100 * common >= `percent` * united. Null and empty
    texts have an empty set and no link. Repeated rows all appear; rows that repeat a doc_id share
    its links. A row without doc_id takes no part and is kept. Other columns are ignored.
    """
    space = Workspace(docs.sparkSession, "near-dup")
    ship(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    id_type = texts.schema["doc_id"].dataType.simpleString()

    signed = texts.mapInArrow(_signatures(shingle_words, rows, hashes), f"doc_id {id_type}, {_SIGNATURE}")
    signed = space.keep(signed, "signatures")
    key = ["set_low", "set_high", "n_shingles"]
    linkable = F.expr("n_shingles > 0 AND doc_id IS NOT NULL")
    same = signed.where(linkable).groupBy(*key).agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    same = space.keep(same, "same")
    # with the node among the keys, copies of one text do not meet in one task
    own = same.select(*(F.col(c).alias(f"own_{c}") for c in key), "node")
    match = [signed[c] == own[f"own_{c}"] for c in key] + [signed["doc_id"] == own["node"]]
    nodes = signed.join(own, match)

    keys = (
        nodes.select("node", F.col("n_shingles").alias("size"), "right", F.posexplode("left").alias("i", "one"))
        .select("node", "size", "i", "one", F.posexplode("right").alias("j", "other"))
        .select(F.xxhash64("i", "one", "j", "other").alias("key"), "node", "size")
    )
    shared = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    shared = shared.where("pivot < last").drop("last")
    buckets = space.keep(keys.join(shared, "key").distinct(), "buckets")

    # sets of all that may be compared, each computed once
    wanted = buckets.select("node").distinct()
    full = texts.join(wanted, texts["doc_id"] == wanted["node"]).select("node", "text")
    sets = space.keep(full.mapInArrow(_shingle_sets(shingle_words), f"node {id_type}, shingles binary"), "sets")
    sets = sets.where("octet_length(shingles) > 0")

    def checked(pairs: DataFrame, name: str) -> DataFrame:
        held = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        held = held.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
        held = held.select("a", "b", "set_a", "set_b")
        counted = held.mapInArrow(_common, f"a {id_type}, b {id_type}, common long, united long")
        return space.keep(counted.withColumn("linked", F.expr(f"100 * common >= {percent} * united")), name)

    found, left = None, buckets.select("key", "node", "size", "pivot")
    pairs = left.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    for step in range(_PIVOTS):
        seen = checked(pairs.distinct(), f"pivot-{step}").where("linked").select("a", "b")
        found = components(space, seen, f"part-{step}", found)
        left, still = space.keep_with(_still_open(left, found), f"open-{step}", F.count(F.lit(1)))
        if not still:
            break
        pairs = left.where("component <> pivot_component").select(
            F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")
        )
    else:
        others = checked(_unsettled(space, left, sets, id_type, percent), "others")
        found = components(space, others.where("linked").select("a", "b"), "final", found)

    placed = same.join(found, "node", "left").select(*key, "copies", F.coalesce("component", "node").alias("component_id"))
    placed, total = space.keep_with(placed, "placed", F.sum("copies"))
    light = signed.select("doc_id", *key)
    alone = light.where(~linkable).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = with_group(light.where(linkable), placed, key, "copies", total).select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))


def _still_open(left: DataFrame, found: DataFrame) -> DataFrame:
    """The keys of `left` (key, node, size, pivot) that hold different components besides their pivot,
    without it and with another pivot: (key, node, size, component, pivot, pivot_component)."""
    rest = left.where("node <> pivot").select("key", "node", "size").join(found, "node", "left")
    rest = rest.withColumn("component", F.coalesce("component", "node"))
    # the order of hashes is the same in all keys, so that keys of one group have few pivots
    least = F.min(F.struct(F.xxhash64("node").alias("order"), "node", "component"))
    keys = rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), least.alias("p"))
    keys = keys.where("x <> y").select("key", F.col("p.node").alias("pivot"), F.col("p.component").alias("pivot_component"))
    return rest.join(keys, "key").select("key", "node", "size", "component", "pivot", "pivot_component")


def _flat_sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all rows one after the other, and how many each row has."""
    raw = [x.as_buffer() for x in batch.column("shingles")]
    sizes = np.array([r.size // 8 for r in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw), np.uint64), sizes


def _cells(bits: int):
    def values_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield (_flat_sets(batch)[0] >> np.uint64(64 - bits)).astype(np.int64)

    return values_of


def _prefixes(levels, bits: int, percent: int):
    """The first places of each set in the order of their cells' levels, as far as anything shares them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes = _flat_sets(batch)
            often = levels.value[(values >> np.uint64(64 - bits)).astype(np.int64)]
            rows = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, often, rows))
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            # the share of a set that may be missing in the other, and one more
            first = sizes - (sizes * percent + 99) // 100 + 1
            kept = np.flatnonzero((place <= first[rows]) & (often[order] > 1))
            owner = pa.array(rows[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(owner) for c in ("node", "size", "component")),
                    pa.array(values[order][kept].view(np.int64)),
                    pa.array(place[kept]),
                ],
                ["node", "size", "component", "shingle", "place"],
            )

    return run


def _unsettled(space: Workspace, left: DataFrame, sets: DataFrame, id_type: str, percent: int) -> DataFrame:
    """Pairs that the comparisons with the pivots left open, by an exact prefix filter.

    Two sets with `percent` in common share one of the first places of either, in an order common
    to all, here from rare to frequent by a table of hashed counts; a shared shingle at places i and j
    bounds what can follow. So variants of one text meet only if their own, rare shingles are few.
    """
    nodes = left.select("node", "size", "component").distinct()
    nodes, total = space.keep_with(nodes, "open-nodes", F.sum("size"))
    runs = space.keep(sets.join(nodes, "node").select("node", "size", "component", "shingles"), "open-sets")
    # any order common to all is right; rough counts of hashed shingles are one, of bounded size
    bits = min(max(16, (2 * total).bit_length()), _MOST_BITS)
    levels = space.spark.sparkContext.broadcast(cell_levels(runs, _cells(bits), 1 << bits))
    ordered = _prefixes(levels, bits, percent)
    prefix = runs.mapInArrow(ordered, f"node {id_type}, size long, component {id_type}, shingle long, place long")
    prefix = space.keep(prefix, "open-prefixes")
    levels.unpersist()
    # a shingle's rows of the component with most of them need not meet each other
    parts = prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("rows"))
    ends = parts.groupBy("shingle").agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("parts"),
        F.max(F.struct("rows", "component"))["component"].alias("largest"),
    )
    ends, total = space.keep_with(ends.where("parts > 1"), "open-ends", F.sum("rows"))
    # written, as both sides below read it: the driver plans and starts each of its joins once;
    # shingles without a row in `ends` fall out of the join
    split = space.keep(with_group(prefix, ends, ["shingle"], "rows", total), "open-split")
    # frequent shingles are cut in pieces on one side, and meet each piece on the other
    pieces = F.expr(f"cast((rows - 1) div {_PIECE} as int)")
    one = split.where("component <> largest").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces)))
    other = split.withColumn("piece", F.pmod(F.hash("node"), pieces + 1))
    columns = ("node", "size", "component", "place")
    one = one.select("shingle", "piece", *(F.col(c).alias(f"{c}_a") for c in columns))
    other = other.select("shingle", "piece", *(F.col(c).alias(f"{c}_b") for c in columns))
    near = F.expr(
        "component_a <> component_b"
        f" AND 100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)"
        f" AND {100 + percent} * (1 + least(size_a - place_a, size_b - place_b)) >= {percent} * (size_a + size_b)"
    )
    pairs = one.join(other, ["shingle", "piece"]).where(near)
    pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return space.keep(pairs.distinct(), "open-pairs")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` that `near_duplicates` keeps; of repeated rows with one doc_id, one."""
    verdict = near_duplicates(docs, **options).where("kept").select("doc_id").distinct()
    other = F.xxhash64("text") if "text" in docs.columns else F.lit(0)
    order = Window.partitionBy("doc_id").orderBy(other)
    known = docs.where("doc_id IS NOT NULL").join(verdict, "doc_id", "left_semi")
    known = known.withColumn("__copy", F.row_number().over(order)).where("__copy = 1").drop("__copy")
    return known.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))

"""Near-duplicates by SimHash: fingerprints, pigeonhole blocks, Hamming verification, components.

A pair within `max_distance` bits differs in at most that many of `blocks` bit blocks, so it shares all bits of some
choice of `blocks - max_distance` blocks. Fingerprints are dealt by (choice, shared bits); each such bucket is verified
by exact Hamming distance and gives the edges of a spanning forest, never all its pairs. Exact copies, and different
texts of equal fingerprint, are folded into one fingerprint first, so a hot text is one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, column_bytes, record, text_bytes, written

BITS = 64
#: So many edges are thinned together in one task.
EDGES = 250_000


def fingerprint(text: bytes, shingle: int = 3, distinct: bool = False) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included unless `distinct`; zero for a text without words."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    if distinct:
        parts = dict.fromkeys(parts)
        n = len(parts)
    h = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in parts), np.uint64, n)
    total = np.zeros(BITS, np.int64)
    for i in range(0, n, 65536):
        total += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distinct: bool = False) -> DataFrame:
    """(doc_id, text_key, fp): fp as a signed long, text_key a hash that tells apart rows of equal id."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, distinct) for t in column_bytes(b, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       text_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def block_masks(max_distance: int, blocks: int, within: int = -1) -> list[int]:
    """Bit masks of all choices of `blocks - max_distance` blocks among the bits set in `within`."""
    bits = [i for i in range(BITS) if within >> i & 1]
    parts = [sum(1 << int(i) for i in p) for p in np.array_split(bits, blocks)]
    return [sum(c) for c in combinations(parts, blocks - max_distance)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def linked(fps: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of distinct fingerprints within `max_distance` bits: each node meets only those that
    no earlier node has reached, so dense groups cost little more than their size. The first node is the one nearest to the majority of
    bits, which is the same in most buckets of a group, so their forests have most edges in common."""
    left, a, b = np.arange(len(fps)), [], []
    if len(fps) > 2:
        bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        centre = np.packbits(2 * bits > len(fps), bitorder="little").view(np.uint64)[0]
        left = np.roll(left, -int(np.bitwise_count(fps ^ centre).argmin()))
    while len(left) > 1:
        seed, left = left[:1], left[1:]
        while len(seed) and len(left):
            part, seed = seed[:256], seed[256:]
            near = np.bitwise_count(fps[part][:, None] ^ fps[left][None, :]) <= max_distance
            hit = near.any(axis=0)
            if hit.any():
                a.append(part[near[:, hit].argmax(axis=0)])
                b.append(left[hit])
                seed, left = np.concatenate([seed, left[hit]]), left[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def bucket_edges(fps: np.ndarray, mask: int, max_distance: int, direct: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one bucket. A larger bucket is dealt anew by the bits that its members need not share: all but about 12
    of those bits are fixed by each choice of further blocks, so no part holds more than some 4096 fingerprints."""
    if len(fps) <= direct:
        return linked(fps, max_distance)
    a, b = [], []
    for inner in block_masks(max_distance, 8, ~mask & (1 << 64) - 1):
        key = fps & np.uint64(inner)
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(order, edges):
            if len(part) > 1:
                x, y = linked(fps[part], max_distance)
                a.append(part[x])
                b.append(part[y])
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def bucket_links(buckets: DataFrame, masks: list[int], max_distance: int, limit: int) -> DataFrame:
    """Edges (a, b) of all buckets (choice, key, fp) with `full` false; members of buckets over `limit` come back with
    `full` true for a finer deal. Rows are streamed in key order; at most `limit` fingerprints are held."""
    kinds = {"choice": pa.int32(), "a": pa.int64(), "b": pa.int64(), "full": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        at, size, over = None, 0, False

        def close():
            if at is None or over or size < 2:
                return None
            fps = np.concatenate(held).view(np.uint64)
            x, y = bucket_edges(fps, masks[at[0]], max_distance)
            return (fps[x].view(np.int64), fps[y].view(np.int64)) if len(x) else None

        for batch in batches:
            choice, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            out_a, out_b, out_c, out_f = [], [], [], []

            def give(c, a, b, full):
                out_a.append(a), out_b.append(b)
                out_c.append(np.full(len(a), c, np.int32)), out_f.append(np.full(len(a), full))

            cuts = np.flatnonzero((np.diff(choice) != 0) | (np.diff(key) != 0)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            alone = (ends - starts == 1)
            keep = np.ones(len(starts), bool)
            keep[1:-1] = ~alone[1:-1]
            for s, e in zip(starts[keep].tolist(), ends[keep].tolist()):
                here = (int(choice[s]), int(key[s]))
                if here != at:
                    if found := close():
                        give(at[0], *found, False)
                    held, at, size, over = [], here, 0, False
                part = fp[s:e].copy()
                size += len(part)
                if not over and size > limit:
                    over = True
                    for x in held:
                        give(at[0], x, x, True)
                    held = []
                if over:
                    give(at[0], part, part, True)
                else:
                    held.append(part)
            if out_a:
                yield record({"choice": np.concatenate(out_c), "a": np.concatenate(out_a), "b": np.concatenate(out_b),
                              "full": np.concatenate(out_f)}, kinds)
        if found := close():
            yield record({"choice": np.full(len(found[0]), at[0], np.int32), "a": found[0], "b": found[1],
                          "full": np.zeros(len(found[0]), bool)}, kinds)

    dealt = buckets.repartition("choice", "key").sortWithinPartitions("choice", "key", "fp")
    return dealt.mapInArrow(run, "choice int, a long, b long, full boolean")


def similar_links(distinct: DataFrame, max_distance: int = 3, blocks: int = 6, limit: int = 65536) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that span every group linked within `max_distance` bits."""
    masks = block_masks(max_distance, blocks)
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(masks)
    ])).alias("k")).select("k.choice", "k.key", "fp")
    first = written(bucket_links(keyed, masks, max_distance, limit))
    edges, crowded = first.where("not full").select("a", "b"), first.where("full")
    if crowded.isEmpty():
        return edges
    inner = [block_masks(max_distance, 8, ~m & (1 << 64) - 1) for m in masks]
    width = len(inner[0])
    fine = [m | i for m, parts in zip(masks, inner) for i in parts]
    table = F.array(*[F.lit(signed(m)) for m in fine])
    finer = crowded.select(F.col("a").alias("fp"), "choice", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("j")).select(
        (F.col("choice") * width + F.col("j")).alias("choice"), "fp").select(
        "choice", F.col("fp").bitwiseAND(F.element_at(table, F.col("choice") + 1)).alias("key"), "fp")
    return edges.union(bucket_links(finer, fine, max_distance, 1 << 30).select("a", "b"))


def thinned(edges: DataFrame, count: int, together: int = EDGES) -> DataFrame:
    """Fewer edges (u, v) with the same components: of some `together` edges, dealt as they come, a task keeps those that join two of its groups. A member of
    a large group has an edge for each way to deal it, of which one is enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = x = above.get(y, y)
            return x

        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (u, v) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                u, v = root(u), root(v)
                if u != v:
                    above[max(u, v)] = min(u, v)
                    keep[i] = True
            if len(above) > together:  # forgotten groups keep more edges, never fewer
                above.clear()
            yield batch.filter(pa.array(keep))

    return edges.select("u", "v").coalesce(max(1, -(-count // together))).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge with the smallest node of its component, by alternating large and small
    stars over a thinned list of edges. Each round is written to the shared folder; no edge list reaches the driver."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    def star(both: DataFrame, small: bool) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        near = both.join(least, both.u == least.w)
        if small:
            out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        else:
            out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where("u != v").distinct()

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    now = written(thinned(now, now.count()))
    before = state(now)
    while before[0]:
        large = star(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), False)
        now = written(star(large, True))
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def hex16(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3,
            blocks: int = 6, limit: int = 65536, distinct: bool = False) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) for every row; root: a fingerprint that stands for the component."""
    rows = written(fingerprints(docs, id_col, text_col, shingle, distinct))
    every = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    root_of = components(similar_links(every.select("fp"), max_distance, blocks, limit))
    member = every.join(root_of, F.col("fp") == F.col("node")).select("root", "fp", "first_id")
    lowest = member.groupBy("root").agg(F.min("first_id").alias("lowest"))
    in_groups = member.join(lowest, "root").select("fp", "root", "lowest")
    ids = every.join(in_groups, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("lowest", "first_id").alias("component_id"))
    return rows.join(written(ids), "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Fingerprint and component of every row of `docs` (see `grouped` for the options).

    Null text counts as empty; texts without words have fingerprint zero and are linked like any other. A null id is
    never a component id unless the whole component has none (then component_id is null). Repeated rows and repeated ids
    each give a row. Empty input gives no rows; other columns are ignored.
    """
    return grouped(docs, **options).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, one of each group of near-duplicates: that of the smallest id (a null id comes last; among
    equal ids the smallest text hash). Columns and their order are kept."""
    groups = grouped(docs, id_col, text_col, **options)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    winners = groups.groupBy("root").agg(F.min(order).alias("w")).select("w.kept_id", "w.kept_key")
    return only(docs, winners, id_col, text_col)


def only(docs: DataFrame, winners: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` named by (kept_id, kept_key), one of each; columns of any name are kept."""
    own = "__row"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    a, b, c, d = (f"{own}_{x}" for x in ("id", "key", "kept_id", "kept_key"))
    marked = docs.withColumns({a: F.col(id_col).cast("long"), b: F.xxhash64(F.col(text_col))})
    kept = marked.join(winners.select(F.col("kept_id").alias(c), F.col("kept_key").alias(d)), F.col(a).eqNullSafe(F.col(c)) & (F.col(b) == F.col(d)), "left_semi")
    return kept.dropDuplicates([a, b]).drop(a, b)

"""Near copies: candidates by SimHash, each confirmed by the exact similarity of word shingles.

Texts are nodes, told apart by a hash of their words. Several fingerprints of a text's words, of unlike bits, are dealt to blocks at once and propose edges as
`simhash` does: a spanning forest of the texts within `max_distance` bits, never all pairs. The texts of one candidate component then meet in a task,
which finds the groups that similar pairs link: texts are compared if they share a shingle among the rarest of each, as two sets that are similar
enough do, and not if they are in one group already.

Components with more text than a task should hold are confirmed by joins instead, with the same result: each edge of the forest by its two shingle sets, and
texts that no confirmed edge has joined once more by the shingles at the head of their sorted sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, column_bytes, text_bytes, written
from .simhash import BITS, block_masks, bucket_links, components, only, signed

#: Bytes of text of a component that meet in one task.
TOGETHER = 64 << 20
#: Edges of one text are dealt over so many parts, as a text with many copies has many edges.
PARTS = 64


def word_fingerprints(words: list[bytes], many: int) -> list[int]:
    """`many` fingerprints of the distinct words: majority bits of their XXH64, mixed anew for each."""
    import xxhash

    if not words:
        return [0] * many
    distinct = set(words)
    h = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in distinct), np.uint64, len(distinct))
    out = []
    for k in range(many):
        if k:
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
        total = np.zeros(BITS, np.int64)
        for i in range(0, len(h), 65536):
            total += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0]))
    return out


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct XXH64 of the word shingles; a shorter text is one shingle, a text without words has none."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    parts = {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in parts), np.uint64, len(parts)).view(np.int64))


def text_nodes(docs: DataFrame, id_col: str, text_col: str, many: int) -> DataFrame:
    """(node, f0, f1, ..., size, first): every distinct text with its fingerprints, its bytes and its first row (see `simhash.only`)."""
    arrow_batches(docs.sparkSession)
    names = [f"f{k}" for k in range(many)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            found = np.zeros((many + 2, b.num_rows), np.uint64)
            for i, text in enumerate(column_bytes(b, "text")):
                words = text.lower().split()
                found[:, i] = [xxhash.xxh64_intdigest(b" ".join(words), 7), *word_fingerprints(words, many), len(text)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x) for x in found.view(np.int64))], names=["doc_id", "text_key", "node", *names, "size"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), text_bytes(text_col).alias("text"))
    made = rows.mapInArrow(run, "doc_id long, text_key long, node long, " + ", ".join(f"{n} long" for n in [*names, "size"]))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    return made.groupBy("node").agg(*[F.min(n).alias(n) for n in [*names, "size"]], F.min(first).alias("first"))


def candidates(nodes: DataFrame, many: int, max_distance: int, blocks: int, limit: int = 65536) -> DataFrame:
    """Edges (a, b) between nodes that span every group linked by one of the fingerprints: all are dealt to buckets at once, by fingerprint number and
    choice of blocks; buckets over `limit` are dealt again by further blocks."""
    masks = block_masks(max_distance, blocks)
    prints = nodes.select("node", F.posexplode(F.array(*[F.col(f"f{k}") for k in range(many)])).alias("f", "fp"))
    of = written(prints.groupBy("f", "fp").agg(F.min("node").alias("stands"), F.count("*").alias("n")))

    def dealt(rows: DataFrame, every: list[int], start: Column) -> DataFrame:
        """(choice, key, fp) for each row and mask; `start` is the choice of the first one."""
        return rows.select(start.alias("start"), "fp", F.posexplode(F.array(*[F.lit(signed(m)) for m in every])).alias("i", "mask")).select(
            (F.col("start") + F.col("i")).cast("int").alias("choice"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")

    first = written(bucket_links(dealt(of, masks, F.col("f") * len(masks)), masks * many, max_distance, limit))
    links = first.where("not full").select(F.floor(F.col("choice") / len(masks)).alias("f"), "a", "b")
    crowded = first.where("full")
    if not crowded.isEmpty():
        inner = [block_masks(max_distance, 8, ~m & (1 << BITS) - 1) for m in masks]
        width = len(inner[0])
        fine = [m | i for m, parts in zip(masks, inner) for i in parts]
        # one mask list for each choice of the first deal: the rows of a choice meet its own further blocks
        rows = crowded.select(F.col("a").alias("fp"), "choice")
        own = F.element_at(F.array(*[F.array(*[F.lit(signed(m | i)) for i in parts]) for m, parts in zip(masks, inner)]), (F.col("choice") % len(masks) + 1).cast("int"))
        again = rows.select("fp", "choice", F.posexplode(own).alias("i", "mask")).select(
            (F.col("choice") * width + F.col("i")).cast("int").alias("choice"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        finer = bucket_links(again, fine * many, max_distance, 1 << 30)
        links = links.union(finer.select(F.floor(F.col("choice") / (width * len(masks))).alias("f"), "a", "b"))
    x, y = of.select("f", F.col("fp").alias("a"), F.col("stands").alias("x")), of.select("f", F.col("fp").alias("b"), F.col("stands").alias("y"))
    edges = links.distinct().join(x, ["f", "a"]).join(y, ["f", "b"]).select("x", "y")
    same = prints.join(of.where("n > 1").select("f", "fp", "stands"), ["f", "fp"]).where("node != stands").select(F.col("node").alias("x"), F.col("stands").alias("y"))
    return edges.union(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def heads(sets: list[np.ndarray], percent: int) -> list[np.ndarray]:
    """The first shingles of each set, rarest first, so many that two sets with `percent` hundredths of their union in common share one."""
    shingle, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(shingle), np.int64)
    rank[np.lexsort((shingle, count))] = np.arange(len(shingle))
    out, at = [], 0
    for s in sets:
        n = len(s)
        out.append(np.sort(rank[place[at : at + n]])[: n - (n * percent + 99) // 100 + 1])
        at += n
    return out


def groups_of(sets: list[np.ndarray], percent: int) -> list[int]:
    """Least place in the group of each set; groups are linked by pairs with at least `percent` hundredths of their union in common."""
    size = [len(s) for s in sets]
    group = list(range(len(sets)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    def similar(i: int, j: int) -> bool:
        if min(size[i], size[j]) * 100 < max(size[i], size[j]) * percent:
            return False
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return common * 100 >= (size[i] + size[j] - common) * percent

    def link(i: int, j: int) -> None:
        i, j = root(i), root(j)
        group[max(i, j)] = min(i, j)

    if len(sets) == 2:
        if similar(0, 1):
            link(0, 1)
        return [root(i) for i in range(2)]
    first = [h.tolist() for h in heads(sets, percent)] if sum(size) else [[]] * len(sets)
    leaders: dict[int, list[int]] = {}
    checked = set()
    for i, own in enumerate(first):  # most texts of a group are like the first of it that came
        found = False
        for j in {j for h in own for j in leaders.get(h, ())}:
            checked.add((j, i))
            if similar(i, j):
                link(i, j)
                found = True
        if not found:
            for h in own:
                leaders.setdefault(h, []).append(i)
    if len({root(i) for i in range(len(sets))}) > 1:
        holders: dict[int, list[int]] = {}
        for i, own in enumerate(first):
            for h in own:
                holders.setdefault(h, []).append(i)
        for some in holders.values():
            if len({root(i) for i in some}) > 1:
                for at, i in enumerate(some):
                    for j in some[at + 1 :]:
                        if (i, j) not in checked and root(i) != root(j):
                            checked.add((i, j))
                            if similar(i, j):
                                link(i, j)
    return [root(i) for i in range(len(sets))]


def met(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(node, root): groups within each component of `members` (component, node, kept_id, kept_key), whose texts meet in a task."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), text_bytes(text_col).alias("text"))
    texts = rows.join(members, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))).select("component", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}

        def close() -> tuple[list[int], list[int]]:
            if not held:
                return [], []
            nodes = sorted(held)
            root = groups_of([held[n] for n in nodes], percent)
            return nodes, [nodes[r] for r in root]

        for b in batches:
            node_out, root_out = [], []
            for component, node, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), column_bytes(b, "text")):
                if component != at:
                    found = close()
                    node_out += found[0]
                    root_out += found[1]
                    at, held = component, {}
                if node not in held:  # a row that is there twice
                    held[node] = shingle_set(text, shingle)
            if node_out:
                yield pa.RecordBatch.from_arrays([pa.array(node_out, pa.int64()), pa.array(root_out, pa.int64())], names=["node", "root"])
        found = close()
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["node", "root"])

    return texts.repartition("component").sortWithinPartitions("component").mapInArrow(run, "node long, root long")


def shingle_sets(docs: DataFrame, nodes: DataFrame, edges: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles) of every text of an edge."""
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    firsts = written(nodes.join(ends, "node").select("node", "first.kept_id", "first.kept_key"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), text_bytes(text_col).alias("text"))
    texts = rows.join(firsts, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, shingle) for t in column_bytes(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles array<bigint>").dropDuplicates(["node"])


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose sets have at least `percent` hundredths of their union in common."""
    dealt = edges
    for end, other in (("a", "b"), ("b", "a")):
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
        wanted = edges.select(F.col(end).alias("node"), F.pmod(F.xxhash64(other), F.lit(PARTS)).alias("part")).distinct()
        side = wanted.join(sets, "node").select(F.col("node").alias(end), "part", F.col("shingles").alias(f"of_{end}"))
        dealt = dealt.join(side, [end, "part"]).drop("part")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return dealt.where(common * 100 >= (F.size("of_a") + F.size("of_b") - common) * percent).select("a", "b")


def unjoined(edges: DataFrame, joined: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) besides `edges` that may be similar enough: of one component of `edges`, not joined by `joined`, and with a
    common shingle among the first of both sorted sets."""
    groups = components(edges).join(components(joined).select("node", F.col("root").alias("sub")), "node", "left").select("node", "root", F.coalesce("sub", "node").alias("sub"))
    groups = written(groups)
    split = groups.groupBy("root").agg(F.min("sub").alias("low"), F.max("sub").alias("high")).where("low < high").select("root")
    n = F.size("shingles")
    heads = written(groups.join(split, "root").join(sets, "node").select("root", "sub", "node", n.alias("n"), F.explode(
        F.slice("shingles", F.lit(1), n - F.floor((n * percent + 99) / 100).cast("int") + 1)).alias("head")))
    crossed = heads.groupBy("root", "head").agg(F.min("sub").alias("low"), F.max("sub").alias("high")).where("low < high").select("root", "head")
    heads = heads.join(crossed, ["root", "head"])
    x, y = (heads.select("root", "head", F.col("sub").alias(f"sub_{e}"), F.col("node").alias(e), F.col("n").alias(f"n_{e}")) for e in "ab")
    pairs = x.join(y, ["root", "head"]).where((F.col("a") < F.col("b")) & (F.col("sub_a") != F.col("sub_b")) & (
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    return pairs.select("a", "b").distinct().join(edges, ["a", "b"], "left_anti")


def linked_groups(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, many: int, max_distance: int, blocks: int,
                  together: int = TOGETHER) -> DataFrame:
    """(node, root) of the texts that are candidates: groups linked by similar pairs; components of more than `together` bytes by joins."""
    edges = written(candidates(nodes, many, max_distance, blocks))
    component = written(components(edges).join(nodes, "node").select(F.col("root").alias("component"), "node", "size", "first.kept_id", "first.kept_key"))
    large = written(component.groupBy("component").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > together).select("component"))
    if large.isEmpty():
        return met(docs, component.drop("size"), id_col, text_col, shingle, percent)
    small = met(docs, component.drop("size").join(large, "component", "left_anti"), id_col, text_col, shingle, percent)
    rest = written(edges.join(component.join(large, "component", "left_semi").select(F.col("node").alias("a")), "a", "left_semi"))
    sets = written(shingle_sets(docs, nodes, rest, id_col, text_col, shingle))
    found = written(confirmed(rest, sets, percent))
    more = written(unjoined(rest, found, sets, percent))
    return small.union(components(found.union(confirmed(more, sets, percent))).select("node", "root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, many: int = 4,
             max_distance: int = 5, blocks: int = 8, together: int = TOGETHER) -> DataFrame:
    """The rows of `docs`, one of each group of texts that pairs similar by `percent` hundredths (common to all distinct word shingles) link: that of the
    smallest id (a null id comes last; among equal ids the smallest text hash). Columns and their order are kept.

    Null text counts as empty; texts without words are one group. Texts that differ in case and white space alone are equal.
    """
    nodes = written(text_nodes(docs, id_col, text_col, many))
    root_of = linked_groups(docs, nodes, id_col, text_col, shingle, percent, many, max_distance, blocks, together)
    winners = nodes.select("node", "first").join(root_of, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("w"))
    return only(docs, winners.select("w.kept_id", "w.kept_key"), id_col, text_col)

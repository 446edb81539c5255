"""Exact top-k by inner product: distributed histogram selection.

Rows are packed into blocks; every query block meets every block of rows, and all scores are counted in a histogram for each query.
The summed histograms tell the bin of each query's k-th score; that bin is divided again until it is one score wide. Then the scores
at or above it are kept, and ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, record, written

BLOCK, QUERIES, TILE, BITS = 8192, 1024, 256, 12


def blocks_of(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of up to `size` rows (id, values as integers, is_query): number, rows, queries, ids, dims, and the values row by row."""
    parts = max(1, -(-rows.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, asks = [], [], []

        def close():
            dims = max(map(len, vectors))
            values = np.zeros((len(vectors), dims), np.int64)
            for i, v in enumerate(vectors):
                values[i, : len(v)] = v
            most = int(np.abs(values).max(initial=0))
            kind = next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
            marks = np.array(asks, bool)
            out = {"rows": [len(ids)], "queries": [int(marks.sum())], "dims": [dims], "most": [most], "kind": [np.dtype(kind).str],
                   "ids": [np.array(ids, np.int64).tobytes()], "asks": [marks.tobytes()], "data": [values.astype(kind).tobytes()]}
            return record(out, {"rows": pa.int32(), "queries": pa.int32(), "dims": pa.int32(), "most": pa.int64(), "kind": pa.string(),
                                "ids": pa.binary(), "asks": pa.binary(), "data": pa.binary()})

        for b in batches:
            ids += b.column(0).to_pylist()
            flat, offsets = b.column(1).values.to_numpy(zero_copy_only=False), b.column(1).offsets.to_numpy()
            vectors += [flat[s:e] for s, e in zip(offsets[:-1], offsets[1:])]
            asks += b.column(2).to_pylist()
            if len(ids) >= size:
                yield close()
                ids, vectors, asks = [], [], []
        if ids:
            yield close()

    packed = rows.select("id", "values", "is_query").repartition(parts).mapInArrow(
        run, "rows int, queries int, dims int, most long, kind string, ids binary, asks binary, data binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], row["kind"]).reshape(row["rows"], row["dims"])


def query_blocks(blocks: DataFrame, parts: int) -> DataFrame:
    """Query rows of all blocks, dealt into `parts` query blocks; `home` and `place` tell each query's own row."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, home, place, vectors = [], [], [], []
        for b in batches:
            for row in b.to_pylist():
                at = np.flatnonzero(np.frombuffer(row["asks"], bool))
                ids.append(np.frombuffer(row["ids"], np.int64)[at])
                home.append(np.full(len(at), row["block"], np.int64))
                place.append(at.astype(np.int64))
                vectors.append(matrix(row)[at].astype(np.int64))
        dims = max(v.shape[1] for v in vectors)
        values = np.concatenate([np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for v in vectors])
        ids, home, place = (np.concatenate(x) for x in (ids, home, place))
        yield record({"qblock": [key[0].as_py()], "rows": [len(ids)], "dims": [dims], "ids": [ids.tobytes()], "home": [home.tobytes()],
                      "place": [place.tobytes()], "data": [values.tobytes()]},
                     {"qblock": pa.int32(), "rows": pa.int32(), "dims": pa.int32(), "ids": pa.binary(), "home": pa.binary(), "place": pa.binary(),
                      "data": pa.binary()})

    asking = blocks.where("queries > 0").withColumn("qblock", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    return asking.select("qblock", "rows", "dims", "kind", "ids", "asks", "data", "block").groupBy("qblock").applyInArrow(
        run, "qblock int, rows int, dims int, ids binary, home binary, place binary, data binary")


def tiles(query: dict, row: dict, exact_below: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first query, scores, own) for runs of queries; own marks each query's own row. Sums below 2^53 are exact in floating point;
    larger ones are summed as integers."""
    values, dims = matrix(row), min(row["dims"], query["dims"])
    kind = np.float64 if exact_below < 1 << 53 else np.int64
    right = values[:, :dims].T.astype(kind)
    q = np.frombuffer(query["data"], np.int64).reshape(query["rows"], query["dims"])[:, :dims]
    home, place = np.frombuffer(query["home"], np.int64), np.frombuffer(query["place"], np.int64)
    for first in range(0, len(q), TILE):
        part = slice(first, first + TILE)
        own = np.zeros((len(q[part]), row["rows"]), bool)
        here = np.flatnonzero(home[part] == row["block"])
        own[here, place[part][here]] = True
        yield first, (q[part].astype(kind) @ right).astype(np.int64), own


def best_scores(rows: DataFrame, k: int, id_col: str, vector_col: str, is_query: Column, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where `is_query` holds, its k highest scores over all other rows.

    Vectors are arrays of integers; null vectors, vectors with a null component and rows of null id take no part. Every row is a candidate
    and every query row a query of its own, also where ids repeat; a vector that is shorter than another counts as filled up with zeros.
    Ties go to the smaller id. With k or fewer candidates, all are returned; an empty table gives no rows. Scores must fit a long.
    """
    spark = rows.sparkSession
    arrow_batches(spark)
    good = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("values"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where(
        "id is not null and values is not null and not exists(values, x -> x is null)")
    blocks = written(blocks_of(good, block))
    n_blocks, asked, most, dims = blocks.agg(F.count("*"), F.coalesce(F.sum("queries"), F.lit(0)), F.coalesce(F.max("most"), F.lit(0)),
                                             F.coalesce(F.max("dims"), F.lit(0))).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = dims * most * most
    parts, salts = -(-asked // query_block), max(1, n_blocks)
    queries = written(query_blocks(blocks, parts))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    right = blocks.select(F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), F.explode(every).alias("qblock"),
                          "block", "rows", "dims", "kind", "ids", "data")
    left = queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def meet(state: DataFrame | None, each, schema: str) -> DataFrame:
        kinds = {n: pa.int64() if t == "long" else pa.int32() for n, t in (c.split() for c in schema.split(", "))}
        asking = left.withColumn("low", F.lit(None).cast("array<bigint>")).withColumn("need", F.lit(None).cast("array<bigint>")) if state is None \
            else left.join(state, "qblock")

        def run(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
            asks = left_rows.to_pylist()
            found = [x for b in right_rows.to_batches(max_chunksize=1) for row in b.to_pylist() for query in asks for x in each(query, row)]
            return pa.Table.from_batches(found) if found else pa.table({n: pa.array([], t) for n, t in kinds.items()})

        return asking.groupBy("qblock", "salt").cogroup(right.groupBy("qblock", "salt")).applyInArrow(run, schema)

    shift, state = max(0, (2 * top).bit_length()), None
    while shift > 0:
        width, shift = shift, max(0, shift - BITS)
        size = 1 << (width - shift)

        def count(query: dict, row: dict, shift=shift, size=size) -> Iterator[pa.RecordBatch]:
            """Histogram of all scores, without the bins below the block's own k-th score: none of them can hold the k-th of all."""
            low = np.array(query["low"], np.int64) if query["low"] is not None else np.zeros(query["rows"], np.int64)
            for first, scores, own in tiles(query, row, top):
                n = len(scores)
                bins = (scores + top - low[first : first + n, None]) >> shift
                above = ((bins >= size) & ~own).sum(axis=1)
                q, c = np.nonzero((bins >= 0) & (bins < size) & ~own)
                table = np.bincount(q * size + bins[q, c], minlength=n * size).reshape(n, size)
                higher = above[:, None] + np.cumsum(table[:, ::-1], axis=1)[:, ::-1] - table
                q, c = np.nonzero((table > 0) & (higher < k))
                yield record({"qblock": np.full(len(q), query["qblock"]), "q": q + first, "bin": c, "n": table[q, c]},
                             {"qblock": pa.int32(), "q": pa.int32(), "bin": pa.int32(), "n": pa.int64()})

        found = meet(state, count, "qblock int, q int, bin int, n long").groupBy("qblock", "q", "bin").agg(F.sum("n").alias("n"))
        by_query = Window.partitionBy("qblock", "q").orderBy(F.desc("bin"))
        placed = queries.select("qblock", F.posexplode(F.array_repeat(F.lit(0), F.col("rows"))).alias("q", "z")) if state is None else \
            state.select("qblock", F.posexplode(F.arrays_zip("low", "need")).alias("q", "was"))
        placed = placed.select("qblock", "q", (F.lit(0) if state is None else F.col("was.low")).cast("long").alias("old"),
                               (F.lit(k) if state is None else F.col("was.need")).cast("long").alias("need"))
        summed = found.withColumn("upto", F.sum("n").over(by_query)).join(placed, ["qblock", "q"])
        chosen = summed.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))).select(
            "qblock", "q", F.shiftleft(F.col("bin").cast("long"), shift).alias("step"), (F.col("need") - (F.col("upto") - F.col("n"))).alias("left"))
        after = placed.join(chosen, ["qblock", "q"], "left").select(
            "qblock", "q", (F.col("old") + F.coalesce("step", F.lit(0))).alias("low"), F.coalesce("left", "need").alias("need"))
        state = written(after.groupBy("qblock").agg(F.array_sort(F.collect_list(F.struct("q", "low", "need"))).alias("s")).select(
            "qblock", F.col("s.low").alias("low"), F.col("s.need").alias("need")))
    if state is None:
        state = queries.select("qblock", F.array_repeat(F.lit(0).cast("long"), F.col("rows")).alias("low"), F.array_repeat(F.lit(k).cast("long"), F.col("rows")).alias("need"))

    def keep(query: dict, row: dict) -> Iterator[pa.RecordBatch]:
        """Scores at or above each query's k-th; of equal ones in a block, the k smallest ids are enough."""
        low, ids = np.array(query["low"], np.int64), np.frombuffer(row["ids"], np.int64)
        asked_ids = np.frombuffer(query["ids"], np.int64)
        for first, scores, own in tiles(query, row, top):
            q, c = np.nonzero((scores + top >= low[first : first + len(scores), None]) & ~own)
            order = np.lexsort((ids[c], -scores[q, c], q))
            q, c = q[order], c[order]
            starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
            rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(q)]])))
            q, c = q[rank < k], c[rank < k]
            yield record({"qblock": np.full(len(q), query["qblock"]), "q": q + first, "query_id": asked_ids[q + first], "vec_id": ids[c], "score": scores[q, c]},
                         {"qblock": pa.int32(), "q": pa.int32(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()})

    final = meet(state, keep, "qblock int, q int, query_id long, vec_id long, score long")
    best = Window.partitionBy("qblock", "q").orderBy(F.desc("score"), "vec_id")
    return final.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(vector: str | Column, by: int = 256) -> Column:
    """Components as floor(by * x); a vector with a null or non-finite component becomes null."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(v, lambda x: F.floor(F.lit(by) * x.cast("double"))))

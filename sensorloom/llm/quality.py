"""Text quality by naive Bayes support vectors.

Indicators of hashed n-grams (bytes, words, word shapes) are scaled by the log ratio of their smoothed class counts; a linear
hinge-loss model on the scaled indicators is fitted by dual coordinate descent, and a logistic curve on held-back margins turns
its margin into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, arrow_batches, column_bytes, learned, record, shipped, split_number, text_bytes, written

BUCKETS = 1 << 18
SAMPLE = 6000
#: Kind of each byte: 0 white space, 1 digit, 2 upper case, 3 lower case, 4 other ASCII, 5 beyond ASCII.
KIND = np.array([0 if c in b" \t\n\r\v\f" else 1 if 48 <= c <= 57 else 2 if 65 <= c <= 90 else 3 if 97 <= c <= 122 else 4 if c < 128 else 5
                 for c in range(256)], np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def indicators(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams of a whole text, each once, in order. `seen` is a scratch array of BUCKETS false values.

    N-grams: 1 to 3 bytes; 1 and 2 words; 1 to 3 word shapes. A shape is what kinds of bytes a word has, the kind of its first and last
    byte, and whether it repeats the word before it.
    """
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)

    def mark(h: np.ndarray) -> None:
        seen[(mixed(h) >> np.uint64(46)).astype(np.int64)] = True

    u = b.astype(np.uint64)
    pair = u[:-1] << np.uint64(8) | u[1:]
    mark(np.unique(u) + np.uint64(1 << 40))
    mark(np.flatnonzero(np.bincount(pair.astype(np.int64), minlength=1)).astype(np.uint64) + np.uint64(2 << 40))
    mark((pair[:-1] << np.uint64(8) | u[2:]) + np.uint64(3 << 40))
    kind = KIND[b]
    inside = kind != 0
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]]))
    if len(starts):
        offset = np.arange(len(b)) - starts[np.maximum(np.searchsorted(starts, np.arange(len(b)), side="right") - 1, 0)]
        spread = mixed((u + np.uint64(1)) * np.uint64(0x1000193) + offset.astype(np.uint64) * np.uint64(0x9E3779B1))
        spread[~inside] = 0
        word = np.add.reduceat(spread, starts)
        again = np.concatenate([[False], word[1:] == word[:-1]])
        kinds = np.bitwise_or.reduceat(np.where(inside, np.uint64(1) << kind.astype(np.uint64), np.uint64(0)), starts)
        shape = kinds | kind[starts].astype(np.uint64) << np.uint64(8) | kind[ends].astype(np.uint64) << np.uint64(12) | again.astype(np.uint64) << np.uint64(16)
        for n, unit in ((2, word), (3, shape)):
            h = np.zeros(len(unit), np.uint64)
            for j in range(n):
                if len(unit) <= j:
                    break
                h = mixed(h[: len(unit) - j] * np.uint64(1000003) + unit[j:])
                mark(h + np.uint64((8 * n + j) << 40))
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 1.0, passes: int = 12,
                            seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear squared-hinge-loss model on unit-length rows of scaled indicators. y is -1 or 1; both classes weigh alike."""
    rng = np.random.default_rng(seed)
    share = {s: cost * len(y) / (2 * max(1, int((y == s).sum()))) for s in (-1, 1)}
    size = [max(1e-9, float(np.sqrt((ratio[r] ** 2).sum() + 1))) for r in rows]
    extra = [1 / s for s in size]
    norm = np.array([float(((ratio[r] / n) ** 2).sum()) + e * e + 1 / (2 * share[int(s)]) for r, n, e, s in zip(rows, size, extra, y)])
    alpha, w, bias = np.zeros(len(y)), np.zeros(len(ratio)), 0.0
    for _ in range(passes):
        most = 0.0
        for i in rng.permutation(len(y)):
            row = rows[i].astype(np.intp, copy=False)
            values = ratio[row] / size[i]
            g = y[i] * (float(w[row] @ values) + bias * extra[i]) - 1 + alpha[i] / (2 * share[int(y[i])])
            new = max(alpha[i] - g / norm[i], 0.0)
            step = (new - alpha[i]) * y[i]
            if step:
                w[row] += step * values
                bias += step * extra[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w, bias


class Model:
    def __init__(self, ratio: np.ndarray, w: np.ndarray, bias: float, slope: float, shift: float):
        self.ratio, self.bias, self.slope, self.shift = ratio.astype(np.float32), bias, slope, shift
        self.weights = (w * ratio).astype(np.float32)

    def margin(self, buckets: np.ndarray) -> float:
        r = self.ratio[buckets]
        return float((self.weights[buckets].sum(dtype=np.float64) + self.bias) / np.sqrt(float(r @ r) + 1))

    def score(self, margin):
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve of label on margin, with softened targets."""
    up, down = int((y > 0).sum()), int((y < 0).sum())
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 2.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = p - target, p * (1 - p) + 1e-9
        G = np.array([(g * margin).sum() + 1e-3 * a, g.sum()])
        H = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum()]])
        step = np.linalg.solve(H + 1e-9 * np.eye(2), G)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.1), b


#: Steps of the draw of the sample, far finer than any share of a table.
DRAWS = 1 << 40


def counts_and_sample(rows: DataFrame, shares: list[float]) -> DataFrame:
    """One pass over all labelled rows (doc_id, text, label): documents of each class (k) that have each bucket, summed within tasks; and the texts
    of a share of each class, chosen by a hash of the id, with a fold of 0 to 3. Bucket BUCKETS counts all documents of a class."""
    kinds = {"k": pa.int32(), "bucket": pa.int32(), "n": pa.int64(), "sample": pa.binary(), "fold": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((2, BUCKETS + 1), np.int64), np.zeros(BUCKETS, bool)
        for b in batches:
            texts, labels, draws, folds = column_bytes(b, "text"), *(b.column(i).to_pylist() for i in (1, 2, 3))
            for text, label in zip(texts, labels):
                total[label, indicators(text, seen)] += 1
                total[label, BUCKETS] += 1
            some = [i for i, d in enumerate(draws) if d < shares[labels[i]] * DRAWS]
            if some:
                yield record({"k": [labels[i] for i in some], "bucket": [None] * len(some), "n": [None] * len(some), "sample": [texts[i] for i in some],
                              "fold": [folds[i] for i in some]}, kinds)
        k, bucket = np.nonzero(total)
        yield record({"k": k, "bucket": bucket, "n": total[k, bucket], "sample": [None] * len(k), "fold": [None] * len(k)}, kinds)

    drawn = rows.select("text", "label", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(DRAWS)).alias("draw"),
                        F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(4)).cast("int").alias("fold"))
    return drawn.mapInArrow(run, "k int, bucket int, n long, sample binary, fold int")


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", label_col: str = "quality",
        sample: int = SAMPLE) -> Model:
    """Learn from the labelled rows where `training` holds: class counts from all of them, the hinge-loss weights from about `sample` of
    them (at most twice that meet in a task), chosen by a hash of the id, up to half of them of each class.

    Texts meet their labels in a shuffled join whatever the size of the labels, so the plan is the same at any scale.
    """
    arrow_batches(docs.sparkSession)
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min(label_col).cast("int").alias("label"))
    rows = docs.where(training).select(F.col(id_col).cast("long").alias("doc_id"), text_bytes().alias("text")).join(
        known.hint("shuffle_hash"), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")
    ids = docs.where(training).select(F.col(id_col).cast("long").alias("doc_id"))
    used = ids.join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("__id"))  # labels of other rows, or of none, say nothing
    labelled = {r["label"]: r["n"] for r in used.groupBy("label").agg(F.count("*").alias("n")).collect()}
    shares = [min(1.0, sample / 2 / max(labelled.get(k, 0), 1)) for k in (0, 1)]
    found = written(counts_and_sample(rows, shares))
    sums = found.where("bucket is not null").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    table = np.zeros((2, BUCKETS + 1))
    table[sums.k, sums.bucket] = sums.n
    counts, totals = table[:, :BUCKETS], table[:, BUCKETS]
    p, q = counts[1] + 1, counts[0] + 1
    ratio = np.log((p / (totals[1] + 2)) / (q / (totals[0] + 2)))
    ratio[counts.sum(axis=0) == 0] = 0

    def learn(texts: list[bytes], kinds: list[int], folds: list[int]) -> dict:
        order = sorted(range(len(texts)), key=lambda i: (texts[i], kinds[i], folds[i]))
        y, fold = np.array([2 * (kinds[i] == 1) - 1 for i in order], np.int64), np.array([folds[i] for i in order], np.int64)
        if len(set(y.tolist())) < 2:
            return {"w": np.zeros(BUCKETS), "bias": 0.0, "slope": 1.0, "shift": float(np.log((totals[1] + 1) / (totals[0] + 1)))}
        seen, margins = np.zeros(BUCKETS, bool), np.zeros(len(y))
        marks = [indicators(texts[i], seen).astype(np.int32) for i in order]
        for k in range(4):
            use, rest = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(rest) and len(set(y[use].tolist())) == 2:
                m = Model(ratio, *dual_coordinate_descent([marks[i] for i in use], ratio, y[use]), 1.0, 0.0)
                margins[rest] = [m.margin(marks[i]) for i in rest]
        w, bias = dual_coordinate_descent(marks, ratio, y)
        slope, shift = logistic(margins, y)
        return {"w": w, "bias": bias, "slope": slope, "shift": shift + float(np.log(shares[0] / shares[1]))}

    return Model(ratio, **learned(found.where("sample is not null").select("sample", "k", "fold").limit(2 * sample), learn))


def annotate(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with __quality_score of every row, from its whole text.

    Null and empty texts have no n-grams and get the model's score of its bias alone. Repeated rows give a row each, null ids are
    passed on, equal texts have equal scores. Empty input gives no rows; extra columns pass through.
    """
    sent = shipped(docs.sparkSession, model)

    def start():
        m, seen = sent(), np.zeros(BUCKETS, bool)
        return lambda texts: {"__quality_score": m.score(np.array([m.margin(indicators(t, seen)) for t in texts]))}

    return add_columns(docs, text_col, start, {"__quality_score": "double"}, keep)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; see `annotate`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(rows, model, "text", ["doc_id"]).toDF("doc_id", "score")


def training_rows(id_col: str = "doc_id") -> Column:
    return split_number(id_col, 5) != 0

"""Language-model scores of whole texts by a small causal self-attention model on subword ids, beside a word-count base score.

Corpus counts come first: every word of all training texts is counted, and the counts of subword ids, of id pairs inside words and of
first and last ids of words follow from them. They give each id a class (the frequent ids one of their own, the others by the company
they keep), the chance of an id in its class after an id of each class, and the first guess of the next class after each id. One layer of
causal attention with relative positions corrects that guess from what stands before: its weights start from a drawn sample and are then trained
on all training texts, where each chunk of texts moves them by itself and the moves are averaged. Classes of like company form groups
of equal size: the next group is guessed first, then the class in it, so a token needs the chances of one group's classes only. Texts are scored in overlapping windows: each
token once, with at least OVERLAP tokens before it where there are as many; windows run in batches with one mask.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, column_bytes, learned, record, slices, text_bytes, word_ids, written

OVERLAP, STRIDE, WIDTH = 16, 32, 16
SINGLES, CLUSTERS, GROUPS = 128, 64, 16
SAMPLE, STEPS, BATCH, RATE = 2000, 300, 192, 0.01
CHUNK_BYTES, CACHED = 8 << 20, 400_000


class Model:
    """`end` starts and ends every text; row `end + 1` of the tables stands for no token. Classes that follow each other form `groups` of equal size."""

    def __init__(self, end: int):
        self.end, self.classes, self.groups = end, SINGLES + CLUSTERS, 1
        self.class_of, self.member_row, self.guess_row = np.zeros(end + 1, np.int64), np.zeros(end + 1, np.int64), np.zeros(end + 2, np.int64)

    def mask(self) -> np.ndarray:
        """Score added for the distance of a key from a query; keys after the query get none of the weight."""
        ahead = np.arange(STRIDE)[:, None] + OVERLAP - np.arange(OVERLAP + STRIDE)[None, :]
        return np.where(ahead >= 0, self.near[np.maximum(ahead, 0)], np.float32(-1e9)).astype(np.float32)

    def tables(self) -> None:
        """Query, key and value of every id, the value's last column counting the token itself; the first guess of the next group."""
        real = np.ones((self.end + 2, 1), np.float32)
        real[-1] = 0
        self.q, self.k = self.emb @ self.wq, self.emb @ self.wk
        for t in (self.q, self.k):
            t *= np.minimum(1, 6 / np.maximum(np.linalg.norm(t, axis=1, keepdims=True), 1e-6))
        self.v = np.concatenate([self.emb @ self.wv, real], axis=1) * real
        self.q, self.k, self.v = (np.ascontiguousarray(t, np.float32) for t in (self.q, self.k, self.v))
        if self.groups > 1:
            self.group_guess = np.empty((len(self.guess), self.groups), np.float32)
            for part in slices(len(self.guess), 1024):
                self.group_guess[part] = np.log(np.exp(self.guess[part].reshape(-1, self.groups, self.classes // self.groups)).sum(axis=2))

    def log_probability(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target (windows, STRIDE) given its window's inputs (windows, OVERLAP + STRIDE)."""
        out = np.zeros(targets.shape, np.float64)
        mask, kinds = self.mask(), self.classes // self.groups
        guess, wo = self.guess.reshape(-1, kinds), np.ascontiguousarray(self.wo.reshape(WIDTH, self.groups, kinds).transpose(1, 0, 2))
        for part in slices(len(inputs), 128):
            x, y = inputs[part], targets[part].reshape(-1)
            here = x[:, OVERLAP:]
            weight = np.matmul(self.q.take(here, axis=0), self.k.take(x, axis=0).transpose(0, 2, 1))
            weight += mask
            np.exp(weight, out=weight)
            mixed = np.matmul(weight, self.v.take(x, axis=0)).reshape(-1, WIDTH + 1)
            flat = mixed[:, :WIDTH] / np.maximum(mixed[:, WIDTH:], 1e-30)
            before = here.reshape(-1)
            row, goal = self.guess_row.take(before), self.class_of.take(y)
            member = self.member[self.member_row.take(y), self.class_of.take(np.minimum(before, self.end))]
            group, goal = goal // kinds, goal % kinds
            logits = guess.take(row * self.groups + group, axis=0)
            if self.groups > 1:
                # tokens of one group stand together while its output weights are applied
                order = np.argsort(group.astype(np.uint8), kind="stable")
                ends, sorted_flat = np.cumsum(np.bincount(group, minlength=self.groups)), flat.take(order, axis=0)
                added = np.empty(logits.shape, np.float32)
                for g, (first, last) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
                    if first < last:
                        np.matmul(sorted_flat[first:last], wo[g], out=added[first:last])
                logits[order] += added
                of_group = flat @ self.wg
                of_group += self.group_guess.take(row, axis=0)
                member += chosen(of_group, group)
            else:
                logits += flat @ wo[0]
            out[part] = (chosen(logits, goal) + member).reshape(-1, STRIDE)
        return out


def chosen(logits: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Log of the share of each row's goal in the row's chances; `logits` is used up."""
    picked = logits[np.arange(len(goal)), goal]
    np.exp(logits, out=logits)
    return picked - np.log(np.maximum(logits @ np.ones(logits.shape[1], np.float32), 1e-37))


def restored(values: dict) -> Model:
    """A model of the values that a broadcast holds."""
    model = object.__new__(Model)
    vars(model).update(values)
    return model


class Windows:
    """Windows of texts whose ids stand one after the other: each token of a text and its end is the target of one window."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, end: int):
        n, self.end = counts + 1, end
        per = -(-n // STRIDE)
        self.text = np.repeat(np.arange(len(counts)), per)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(per) - per, per)
        self.first, self.size = (np.cumsum(n) - n)[self.text], n[self.text]
        self.inputs, self.targets = np.full(int(n.sum()), end, ids.dtype), np.full(int(n.sum()), end, ids.dtype)
        body = np.ones(len(self.inputs), bool)
        body[np.cumsum(n) - n] = False
        self.inputs[body] = ids
        body[:] = True
        body[np.cumsum(n) - 1] = False
        self.targets[body] = ids

    def __len__(self) -> int:
        return len(self.text)

    def of(self, some: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, targets and which targets are real, of some windows."""
        at = self.number[some, None] * STRIDE + np.arange(-OVERLAP, STRIDE)[None, :]
        fine = (at >= 0) & (at < self.size[some, None])
        place = np.where(fine, at + self.first[some, None], 0)
        inputs, targets = (x.take(place).astype(np.int64, copy=False) for x in (self.inputs, self.targets))
        return np.where(fine, inputs, self.end + 1), np.where(fine, targets, self.end)[:, OVERLAP:], fine[:, OVERLAP:]


def windows(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets, which targets are real, and the text of each window, for texts whose ids stand one after the other."""
    found = Windows(ids, counts, end)
    return *found.of(slice(None)), found.text


def cluster(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Number of the nearest of k directions for each row, by spherical k-means."""
    rng = np.random.default_rng(seed)
    unit = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    centres = unit[rng.permutation(len(unit))[:k]]
    found = np.zeros(len(unit), np.int64)
    for _ in range(rounds):
        found = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, found, unit)
        filled = np.linalg.norm(sums, axis=1) > 0
        centres[filled] = sums[filled] / np.linalg.norm(sums[filled], axis=1, keepdims=True)
    return found


def alike(rows: np.ndarray, groups: int) -> np.ndarray:
    """An order of the rows in which each of `groups` equal parts (a power of two) holds rows that are alike: parts are halved along their widest direction."""
    unit = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    parts = [np.arange(len(rows))]
    while len(parts) < groups:
        halves = []
        for at in parts:
            centred = (unit[at] - unit[at].mean(axis=0)).astype(np.float64)
            ranked = at[np.argsort(np.linalg.svd(centred, full_matrices=False)[0][:, 0], kind="stable")]
            halves += [ranked[: len(at) // 2], ranked[len(at) // 2 :]]
        parts = halves
    return np.concatenate(parts)


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and the number of ids of each, from a binary column that holds them as unsigned 16-bit numbers."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    held = np.frombuffer(data[ends[0] : ends[-1]].to_pybytes(), np.uint16) if data is not None else np.zeros(0, np.uint16)
    return held, np.diff(ends) // 2


def binary_ids(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The column of which `ids_of` gives these ids and counts."""
    ends = np.concatenate([[0], 2 * np.cumsum(counts)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype(np.uint16, copy=False).tobytes())])


def with_ids(words: DataFrame, vocabulary: str) -> DataFrame:
    """Counted words with their subword ids (binary, see `ids_of`). Rows of one word stand together, so each word is encoded about once, and not again in every chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary, CACHED)
        for b in batches:
            coded = b.column(1).cast(pa.binary()).dictionary_encode()
            flat, counts = encoder.encode(coded.dictionary.to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, binary_ids(flat, counts).take(coded.indices)], names=[*names, "ids"])

    names = ["chunk", "word", "c", "leads"]
    return words.select(*names).mapInArrow(run, "chunk int, word binary, c long, leads boolean, ids binary")


def id_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n): how often id b follows id a inside the counted words (ids, c); -1 stands for a word's edges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, fields = 1 << 17, {"a": pa.int32(), "b": pa.int32(), "n": pa.int64()}
        held, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64)), []

        def folded() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([held[0], *[k for k, _ in waiting]]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([held[1], *[n for _, n in waiting]]), len(keys)).astype(np.int64)

        for b in batches:
            flat, counts = ids_of(b.column(0))
            n = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            some = counts > 0
            begin = (np.cumsum(counts) - counts)[some]
            after = np.full(len(flat), -1, np.int64)
            after[:-1] = flat[1:]
            after[begin + counts[some] - 1] = -1
            waiting.append((np.concatenate([(flat.astype(np.int64) + 1) * size + after + 1, flat[begin].astype(np.int64) + 1]), np.concatenate([np.repeat(n, counts), n[some]])))
            if sum(len(k) for k, _ in waiting) > 200_000:
                held, waiting = folded(), []
                if len(held[0]) > 500_000:
                    yield record({"a": held[0] // size - 1, "b": held[0] % size - 1, "n": held[1]}, fields)
                    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys, sums = folded()
        yield record({"a": keys // size - 1, "b": keys % size - 1, "n": sums}, fields)

    return words.select("ids", "c").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def from_counts(pairs: DataFrame, texts: int, end: int) -> Model:
    """Classes and first guesses from the id pairs of the corpus. What reaches the driver is bounded by the vocabulary: a row for an id, an
    id and a frequent id, an id and a class."""
    model = Model(end)
    counts = np.zeros(end + 1)
    for a, n in pairs.where("a >= 0").groupBy("a").agg(F.sum("n")).collect():
        counts[a] = n
    counts[end] += texts
    top = np.argsort(-counts, kind="stable")[:SINGLES]
    if end not in top:
        top[-1] = end
    model.class_of[:] = -1
    model.class_of[top] = np.arange(SINGLES)
    rest = np.flatnonzero((model.class_of < 0) & (counts > 0))
    column = {int(t): i for i, t in enumerate(top)} | {-1: SINGLES}
    company = np.zeros((end + 1, 2 * (SINGLES + 1)), np.float32)
    frequent = [int(t) for t in column]
    near = pairs.where(F.col("a").isin(frequent) | F.col("b").isin(frequent)).toArrow()
    a, b, n = (near.column(i).to_numpy().astype(np.int64) for i in range(3))
    place = np.full(end + 2, -1)
    place[list(column)] = list(column.values())  # -1 is the last place
    some = (place[b] >= 0) & (a >= 0)
    np.add.at(company, (a[some], place[b[some]]), n[some])
    some = (place[a] >= 0) & (b >= 0)
    np.add.at(company, (b[some], SINGLES + 1 + place[a[some]]), n[some])
    if len(rest):
        model.class_of[rest] = SINGLES + cluster(np.sqrt(company[rest]), CLUSTERS)
    unseen = np.flatnonzero(model.class_of < 0)
    model.class_of[unseen] = SINGLES + unseen % CLUSTERS
    kept = np.zeros((model.classes, company.shape[1]))
    np.add.at(kept, model.class_of, company)
    place_of = np.empty(model.classes, np.int64)
    place_of[alike(np.sqrt(kept), GROUPS)] = np.arange(model.classes)
    model.class_of, model.groups = place_of[model.class_of], GROUPS
    seen, kinds, mapping = np.flatnonzero(counts > 0), model.classes, model.class_of

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the pairs by (id, class of the next), (id, class of the one before), first ids and last ids."""
        for batch in batches:
            a, b, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            inner, begins, ends = (a >= 0) & (b >= 0), a < 0, b < 0
            key = np.concatenate([a[inner] * kinds + mapping[b[inner]], b[inner] * kinds + mapping[a[inner]], b[begins] * kinds, a[ends] * kinds])
            key = key * 4 + np.repeat(np.arange(4), [inner.sum(), inner.sum(), begins.sum(), ends.sum()])
            key, at = np.unique(key, return_inverse=True)
            total = np.bincount(at, np.concatenate([n[inner], n[inner], n[begins], n[ends]]))
            yield record({"kind": key % 4, "id": key // 4 // kinds, "k": key // 4 % kinds, "n": total},
                         {"kind": pa.int32(), "id": pa.int32(), "k": pa.int32(), "n": pa.float64()})

    del near, company, a, b, n, some, place
    sums = pairs.mapInArrow(by_class, "kind int, id int, k int, n double").groupBy("kind", "id", "k").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    tables = [np.zeros((end + 1, kinds)) for _ in range(2)] + [np.zeros((end + 1, 1)) for _ in range(2)]
    for kind, t in enumerate(tables):
        some = sums[sums.kind == kind]
        t[some.id, some.k if kind < 2 else 0] = some.n
    after, behind, first, last = tables[0], tables[1], tables[2][:, 0], tables[3][:, 0]
    del sums, some, tables, t
    first[end] += texts
    first = (first + 1e-6) / (first + 1e-6).sum()
    first_kind, last_kind = np.bincount(mapping, first, kinds), np.bincount(mapping, last, kinds)
    after += last[:, None] * first_kind
    behind += first[:, None] * last_kind
    after[end] = texts * first_kind
    behind[:, mapping[end]] += first * texts

    soft = counts + 0.1
    totals = np.bincount(mapping, soft, kinds)
    general, alone = totals / totals.sum(), soft / totals[mapping]
    model.guess_row[:] = len(seen)
    model.guess_row[seen] = np.arange(len(seen))
    # Large tables change in place, so that few of them are held at a time.
    guess = after[seen]
    del after
    total = guess.sum(axis=1, keepdims=True) + 5
    guess += 5 * general
    guess /= total
    np.log(guess, out=guess)
    model.guess = np.concatenate([guess, np.log(general)[None]], dtype=np.float32, casting="same_kind")
    del guess
    # Ids that were not seen share a row for each class, as all of one class have equal chances.
    of_class = np.zeros((kinds, kinds))
    np.add.at(of_class, mapping, behind)
    model.member_row = len(seen) + mapping
    model.member_row[seen] = np.arange(len(seen))
    rare = np.bincount(mapping, np.where(counts > 0, 0, alone), kinds) / np.maximum(np.bincount(mapping, counts == 0, kinds), 1)
    known = behind[seen]
    del behind
    known += 10 * alone[seen, None]
    for part in slices(len(seen), 4096):
        known[part] /= of_class[mapping[seen[part]]] + 10
    np.log(known, out=known)
    model.member = np.concatenate([known, np.log(np.maximum(10 * rare[:, None], 1e-30) / (of_class + 10))], dtype=np.float32, casting="same_kind")
    del known
    rng = np.random.default_rng(11)
    model.emb = rng.normal(0, 0.3, (end + 2, WIDTH)).astype(np.float32)
    model.emb[-1] = 0
    model.wq, model.wk, model.wv = (rng.normal(0, 0.25, (WIDTH, WIDTH)).astype(np.float32) for _ in range(3))
    model.wo, model.wg = np.zeros((WIDTH, model.classes), np.float32), np.zeros((WIDTH, model.groups), np.float32)
    model.near = np.zeros(OVERLAP + STRIDE, np.float32)
    model.tables()
    return model


def missed(logits: np.ndarray, goal: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Gradient of the cross-entropy, `share` of each row: the chances of the row less its goal; `logits` is used up."""
    np.minimum(logits, 60, out=logits)
    np.exp(logits, out=logits)
    logits *= (share / np.maximum(logits @ np.ones(logits.shape[1], np.float32), 1e-37))[:, None]
    logits[np.arange(len(goal)), goal] -= share
    return logits


def gradients(model: Model, x: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradient of the mean cross-entropy of the next group and class over a batch of windows, that of `emb` for the ids of the batch alone; and these ids."""
    kinds, groups, span = model.classes // model.groups, model.groups, OVERLAP + STRIDE
    seen = np.zeros(model.end + 2, bool)
    seen[x.reshape(-1)] = True
    ids = np.flatnonzero(seen)
    place = np.empty(model.end + 2, np.int64)
    place[ids] = np.arange(len(ids))
    at = place.take(x)
    emb, valid = model.emb.take(ids, axis=0), (ids <= model.end).astype(np.float32)[:, None]
    q = (emb @ model.wq).take(at[:, OVERLAP:], axis=0)
    k, v = (emb @ model.wk).take(at, axis=0), np.concatenate([emb @ model.wv * valid, valid], axis=1).take(at, axis=0)
    w = np.matmul(q, k.transpose(0, 2, 1))
    w += model.mask()
    np.minimum(w, 30, out=w)
    np.exp(w, out=w)
    mixed = np.matmul(w, v).reshape(-1, WIDTH + 1)
    total = np.maximum(mixed[:, WIDTH:], 1e-30)
    flat = mixed[:, :WIDTH] / total
    row, goal = model.guess_row.take(x[:, OVERLAP:].reshape(-1)), model.class_of.take(y.reshape(-1))
    share = real.reshape(-1).astype(np.float32) / np.float32(max(1, real.sum()))
    group, goal = goal // kinds, goal % kinds
    # tokens of one group stand together while its output weights are applied
    order = np.argsort(group.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=groups))
    parts = [(g, slice(first, last)) for g, (first, last) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)) if first < last]
    wo = np.ascontiguousarray(model.wo.reshape(WIDTH, groups, kinds).transpose(1, 0, 2))
    sorted_flat, logits = flat.take(order, axis=0), model.guess.reshape(-1, kinds).take((row * groups + group).take(order), axis=0)
    for g, part in parts:
        logits[part] += sorted_flat[part] @ wo[g]
    logits = missed(logits, goal.take(order), share.take(order))
    d_wo, moved = np.zeros_like(wo), np.empty_like(sorted_flat)
    for g, part in parts:
        d_wo[g] = sorted_flat[part].T @ logits[part]
        np.matmul(logits[part], wo[g].T, out=moved[part])
    d_flat = np.empty_like(flat)
    d_flat[order] = moved
    found = {"wo": d_wo.transpose(1, 0, 2).reshape(WIDTH, -1)}
    if groups > 1:
        of_group = flat @ model.wg
        of_group += model.group_guess.take(row, axis=0)
        of_group = missed(of_group, group, share)
        found["wg"] = flat.T @ of_group
        d_flat += of_group @ model.wg.T
    d_mixed = np.concatenate([d_flat, -np.einsum("ij,ij->i", d_flat, flat)[:, None]], axis=1)
    d_mixed /= total
    d_mixed = d_mixed.reshape(len(x), STRIDE, WIDTH + 1)
    d_v = np.matmul(w.transpose(0, 2, 1), d_mixed[:, :, :WIDTH]).reshape(-1, WIDTH)
    w *= np.matmul(d_mixed, v.transpose(0, 2, 1))
    d_q, d_k = np.matmul(w, k).reshape(-1, WIDTH), np.matmul(w.transpose(0, 2, 1), q).reshape(-1, WIDTH)
    d_v *= valid.take(at.reshape(-1), axis=0)
    ahead = np.arange(STRIDE)[:, None] + OVERLAP - np.arange(span)[None, :]
    found["near"] = np.bincount(np.maximum(ahead, 0).reshape(-1), np.where(ahead >= 0, w.sum(axis=0), 0).reshape(-1), span)
    e = emb.take(at, axis=0)
    found |= {"wq": e[:, OVERLAP:].reshape(-1, WIDTH).T @ d_q, "wk": e.reshape(-1, WIDTH).T @ d_k, "wv": e.reshape(-1, WIDTH).T @ d_v}
    d_e = d_k @ model.wk.T
    d_e += d_v @ model.wv.T
    d_e.reshape(len(x), span, WIDTH)[:, OVERLAP:] += (d_q @ model.wq.T).reshape(len(x), STRIDE, WIDTH)
    found["emb"] = np.stack([np.bincount(at.reshape(-1), column, len(ids)) for column in np.ascontiguousarray(d_e.T)], axis=1).astype(np.float32) * valid
    return found, ids


class Adam:
    """Steps down the gradients; moments of an id change with the batches that hold it."""

    def __init__(self, model: Model):
        self.model, self.step = model, 0
        self.first, self.second = ({n: np.zeros_like(getattr(model, n)) for n in weights(model)} for _ in range(2))

    def move(self, grads: dict[str, np.ndarray], ids: np.ndarray, rate: float) -> None:
        self.step += 1
        for n, grad in grads.items():
            at = ids if n == "emb" else slice(None)
            first = 0.9 * self.first[n][at] + 0.1 * grad
            second = 0.99 * self.second[n][at] + 0.01 * grad**2
            self.first[n][at], self.second[n][at] = first, second
            getattr(self.model, n)[at] -= (rate * (first / (1 - 0.9**self.step)) / (np.sqrt(second / (1 - 0.99**self.step)) + 1e-8)).astype(np.float32)


def weights(model: Model) -> list[str]:
    """Names of what is trained."""
    return ["emb", "wq", "wk", "wv", "wo", "near", *["wg"] * (model.groups > 1)]


def train(model: Model, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray, steps: int = STEPS, rate: float = RATE, seed: int = 9) -> Model:
    """Adam on the cross-entropy of the next group and class, over random batches of windows."""
    if not len(inputs):
        return model
    rng, adam = np.random.default_rng(seed), Adam(model)
    for step in range(1, steps + 1):
        some = rng.integers(0, len(inputs), BATCH)
        adam.move(*gradients(model, inputs[some], targets[some], real[some]), rate * min(1, step / 20) * (1 - 0.9 * step / steps))
    model.tables()
    return model


def chunked(docs: DataFrame, training: Column, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows with a chunk number, dealt by a hash of the row so that chunks have some CHUNK_BYTES of text; and the number of training rows."""
    size, train_rows = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)), F.count_if(training)).first()
    chunks = max(1, -(-size // CHUNK_BYTES))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"), training.alias("training"),
                       F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)).cast("int").alias("chunk")), train_rows


def counted_words(rows: DataFrame) -> DataFrame:
    """(chunk, word, c, leads): the words of each chunk with their counts in all training rows; `leads` marks one row of each word."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Counter(), set()
        for b in batches:
            for text, use in zip(column_bytes(b, "text"), b.column("training").to_pylist()):
                (known if use else seen).update(text.lower().split())
        seen.difference_update(known)
        for some, n in ((list(known), list(known.values())), (list(seen), [0] * len(seen))):
            for part in slices(len(some), 50_000):
                yield record({"chunk": [key[0].as_py()] * len(some[part]), "word": some[part], "n": n[part]}, {"chunk": pa.int32(), "word": pa.binary(), "n": pa.int64()})

    by_chunk = rows.groupBy("chunk").applyInArrow(run, "chunk int, word binary, n long")
    by_word = Window.partitionBy("word")
    return by_chunk.select("chunk", "word", F.sum("n").over(by_word).alias("c"), (F.col("chunk") == F.min("chunk").over(by_word)).alias("leads"))


def fit(rows: DataFrame, words: DataFrame, texts: int, vocabulary: str, sample: int = SAMPLE, coded: DataFrame | None = None) -> Model:
    """Corpus counts from all training rows. Attention weights start from windows of about `sample` of them, chosen by a hash of the row, and are
    then trained on the windows of all of them: on the ids of `coded` (see `coded_texts`), or else on those of `rows`."""
    from tokenizers import Tokenizer

    end = Tokenizer.from_file(vocabulary).token_to_id("<|endoftext|>")
    leading = words.where("leads and c > 0")
    pairs = written(id_pairs(leading if "ids" in words.columns else with_ids(leading, vocabulary)))
    model = from_counts(pairs, texts, end)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1_000_000))
    drawn = rows.where(F.col("training") & (draw < max(1, round(1_000_000 * min(1.0, sample / max(texts, 1)))))).select("text").limit(2 * sample)
    kept, member = weights(model), vars(model).pop("member")  # training needs no chances within classes
    sent = rows.sparkSession.sparkContext.broadcast(vars(model))

    def learn(some: list[bytes]) -> dict:
        m = restored(sent.value)
        for name in kept:  # what changes in place is not the broadcast's own
            setattr(m, name, getattr(m, name).copy())
        flat, counts = word_ids(vocabulary, CACHED).encode(sorted(some))
        inputs, targets, real, text = windows(flat, counts, end)
        order = np.random.default_rng(1).permutation(len(inputs))[: STEPS * BATCH]
        m = train(m, inputs[order], targets[order], real[order])
        return {name: getattr(m, name) for name in kept}

    vars(model).update(learned(drawn, learn))
    sent.destroy()
    if coded is None:
        coded = rows.where("training").mapInArrow(lambda batches: plainly_coded(batches, vocabulary), "chunk int, ids binary").repartition("chunk").sortWithinPartitions("chunk")
    else:
        coded = coded.where("training")
    train_on_all(model, coded)
    model.member = member
    model.tables()
    return model


def plainly_coded(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Chunk and ids of each text, for rows whose words were not given ids before."""
    for b in batches:
        flat, counts = word_ids(vocabulary, CACHED).encode(column_bytes(b, "text"))
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("chunk")), binary_ids(flat, counts)], names=["chunk", "ids"])


def train_on_all(model: Model, coded: DataFrame) -> None:
    """One pass over the windows of all texts (chunk, ids), where those of a chunk stand together. Each chunk moves the given weights by itself, and
    the moves are averaged by tokens; the row of an id by how often each chunk holds it. A task gives one sum of the moves of its chunks."""
    sent, blocks = coded.sparkSession.sparkContext.broadcast(vars(model)), 1024

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, held, number = restored(sent.value), [], None
        sums = {n: np.zeros(getattr(start, n).shape, np.float64) for n in weights(start)}
        seen, tokens = np.zeros(len(start.emb)), 0

        def learn() -> int:
            m = restored(sent.value)
            for n in sums:
                setattr(m, n, getattr(m, n).copy())
            held.sort()
            flat, counts = np.frombuffer(b"".join(held), np.uint16), np.array([len(x) // 2 for x in held])
            found, adam = Windows(flat, counts, m.end), Adam(m)
            order = np.random.default_rng(4).permutation(len(found))
            steps = -(-len(order) // BATCH)
            for step, part in enumerate(slices(len(order), BATCH), 1):
                adam.move(*gradients(m, *found.of(order[part])), RATE * min(1, step / 20) * (1 - 0.9 * step / steps))
            times = np.bincount(flat, minlength=len(seen))
            times[m.end] += len(held)
            for n in sums:
                sums[n] += (getattr(m, n) - getattr(start, n)) * (times[:, None] if n == "emb" else times.sum())
            seen[:] += times
            held.clear()
            return int(times.sum())

        for b in batches:
            for chunk, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held and chunk != number:
                    tokens += learn()
                number = chunk
                held.append(ids)
        if held:
            tokens += learn()
        if tokens:
            emb = np.concatenate([sums.pop("emb"), seen[:, None]], axis=1)
            given = [(f"emb {part.start:09d}", emb[part]) for part in slices(len(emb), blocks)]
            for name, x in [*given, *((n, np.append(x, tokens)) for n, x in sums.items())]:
                yield record({"name": [name], "sums": [np.ascontiguousarray(x, np.float64).tobytes()]}, {"name": pa.string(), "sums": pa.binary()})

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(x, np.float64) for b in batches for x in b.column(1).to_pylist())
        yield record({"name": [key[0].as_py()], "sums": [total.tobytes()]}, {"name": pa.string(), "sums": pa.binary()})

    moves = coded.select("chunk", "ids").mapInArrow(run, "name string, sums binary").groupBy("name").applyInArrow(added, "name string, sums binary").collect()
    sent.destroy()
    for name, x in moves:
        total = np.frombuffer(x, np.float64)
        if name.startswith("emb "):
            first, total = int(name[4:]), total.reshape(-1, WIDTH + 1)
            model.emb[first : first + len(total)] += (total[:, :-1] / np.maximum(total[:, -1:], 1)).astype(np.float32)
        else:
            getattr(model, name)[...] += (total[:-1] / total[-1]).reshape(getattr(model, name).shape).astype(np.float32)


def coded_texts(rows: DataFrame, words: DataFrame, texts: int, word_total: int, distinct: int, vocabulary: str) -> DataFrame:
    """The rows with the ids of their texts (binary, see `ids_of`) instead of these, their counts of words and their base score. Rows of a chunk stand together."""
    total, kinds = word_total + texts, distinct + (texts > 0)
    out = {"chunk": pa.int32(), "doc_id": pa.int64(), "training": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64()}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found, floor = [], np.log10(total + kinds + 1)
        right = right.combine_chunks()
        known = {w: i for i, w in enumerate(right.column("word").to_pylist())}
        c_of = right.column("c").to_numpy()
        ids, length = ids_of(right.column("ids").combine_chunks())
        start = np.cumsum(length, dtype=np.int64) - length

        for b in left.to_batches(max_chunksize=500):
            some = column_bytes(b, "text")
            words = [t.lower().split() for t in some]
            n_words = np.fromiter(map(len, words), np.int64, len(some))
            at = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
            c, text = c_of[at], np.repeat(np.arange(len(some)), n_words)
            base = np.bincount(text, np.log10(c + 1), len(some))
            hits = np.bincount(text, c > 0, len(some)).astype(np.int64)
            n = n_words + 1
            base += np.log10(texts + 1) - n * floor
            lengths = length[at].astype(np.int64)
            before = np.cumsum(lengths) - lengths
            flat = ids[np.repeat(start[at] - before, lengths) + np.arange(int(lengths.sum()))]
            counts = np.bincount(text, lengths, len(some)).astype(np.int64)
            # a special token counts only as it is written, so a text that may hold one is encoded with its own case
            spelled = [i for i, t in enumerate(some) if b"<|" in t]
            if spelled:
                parts = np.split(flat, np.cumsum(counts)[:-1])
                own, own_counts = word_ids(vocabulary, CACHED).encode([some[i] for i in spelled])
                for i, part in zip(spelled, np.split(own, np.cumsum(own_counts)[:-1])):
                    parts[i] = part
                flat, counts = np.concatenate(parts), np.array([len(p) for p in parts])
            made = record({"chunk": b.column("chunk"), "doc_id": b.column("doc_id"), "training": b.column("training"), "n_tokens": n,
                           "n_known": hits + (texts > 0), "base_score": base}, out)
            found.append(pa.RecordBatch.from_arrays([*made.columns, binary_ids(flat, counts)], names=[*out, "ids"]))
        return pa.Table.from_batches(found, pa.schema([*out.items(), ("ids", pa.binary())]))

    return rows.groupBy("chunk").cogroup(words.select("chunk", "word", "c", "ids").groupBy("chunk")).applyInArrow(
        run, "chunk int, doc_id long, training boolean, n_tokens long, n_known long, base_score double, ids binary")


def score_texts(docs: DataFrame, training: Column, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score of every row, from its whole text.

    base_score: sum of log10((c + 1) / (N + V + 1)) over the text's words and one end. score: log10 probability of the text's subword ids and
    the end under the attention model. Null text counts as empty and has the end alone. Repeated rows give a row each, equal
    texts have equal scores, a null id is passed on and trains. Without training rows the model knows no counts and guesses evenly.
    Empty input gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows, texts = chunked(docs, training, id_col, text_col)
    words = written(with_ids(counted_words(rows), vocabulary))
    word_total, distinct = words.where("leads and c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    coded = written(coded_texts(rows, words, texts, word_total, distinct, vocabulary), "zstd")
    model = fit(rows, words, texts, vocabulary, coded=coded)
    sent = spark.sparkContext.broadcast(vars(model))  # written to its file array by array, without a copy in the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for whole in batches:
            m = m or restored(sent.value)
            for part in slices(whole.num_rows, 500):
                b = whole.slice(part.start, part.stop - part.start)
                flat, counts = ids_of(b.column(b.num_columns - 1))
                inputs, targets, real, text = windows(flat, counts.astype(np.int64), m.end)
                logs = (m.log_probability(inputs, targets) * real).sum(axis=1)
                score = np.bincount(text, logs, b.num_rows) / np.log(10)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score)], names=[*names, "score"])

    names = ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score"]
    return coded.withColumn("train_tokens", F.lit(word_total + texts).cast("long")).select(*names, "ids").mapInArrow(
        run, "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

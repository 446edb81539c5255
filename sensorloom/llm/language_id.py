"""Language of words in code-switched text by a linear-chain conditional random field.

Words (runs of letters) are labelled by forward-backward over a text; their features are affixes, inner character n-grams
(hashed) and a lexicon of hashed word counts by language. Transitions are learned on sequences in which sentences of
different languages follow each other. A text's language has the largest sum of word posteriors, its score is that
language's share.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, arrow_batches, column_bytes, record, shipped, slices, text_bytes, worker_cache

BUCKETS = 1 << 16
LEXICON = 1 << 17
SAMPLE = 3000
LONGEST = 24
#: Letters of a unit of a longer run, and from one unit to the next, so that each four letters in a row are in one unit.
UNIT, STEP = 6, 3
#: Least rows drawn of a language that has them, runs drawn of a text, sequences that begin with a language.
LEAST_ROWS, TEXT_RUNS, LANGUAGE_RUNS = 300, 20, 4000


def word_bytes(text: bytes) -> list[bytes]:
    """Lower-case words: runs of letters (any script), as UTF-8. A run of over LONGEST bytes, as in scripts without spaces, gives
    overlapping units instead, whose ends inside the run are marked."""
    import re

    pattern = worker_cache("letters", lambda: re.compile(r"[^\W\d_]+"))
    words = " ".join(pattern.findall(text.decode("utf-8", "replace").lower())).encode().split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [u for w in words for u in ((w,) if len(w) <= LONGEST else units(w.decode()))]


def units(run: str) -> list[bytes]:
    last = len(run) - UNIT
    return [b"\x03" * (i > 0) + run[i : i + UNIT].encode() + b"\x03" * (i < last) for i in range(0, last + STEP, STEP)]


def char_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words between marks, one row each, and lengths. Words have LONGEST bytes at most, units two more."""
    marked = [b"\x01" + w + b"\x02" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    table = np.array(marked, dtype=f"S{LONGEST + 4}").view(np.uint8).reshape(len(marked), LONGEST + 4).astype(np.uint64)
    return table, lengths


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_keys(table: np.ndarray) -> np.ndarray:
    h = np.zeros(len(table), np.uint64)
    for j in range(table.shape[1]):
        h = mixed(h + table[:, j] + np.uint64(7))
    return (h % np.uint64(LEXICON)).astype(np.int64)


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features as (buckets, row numbers), and the lexicon bucket of each word: prefixes and suffixes of 1 to 4 bytes with
    their marks, and n-grams of 2 to 4 bytes anywhere."""
    table, lengths = char_table(words)
    cols, rows = [], []
    everyone = np.arange(len(words))
    width = table.shape[1]
    for n in (2, 3, 4):
        h = np.full((len(words), width - n + 1), n, np.uint64)
        for j in range(n):
            h = mixed(h * np.uint64(257) + table[:, j : width - n + 1 + j])
        r, c = np.nonzero(np.arange(width - n + 1)[None, :] + n <= lengths[:, None])
        cols.append(h[r, c])
        rows.append(r)
    for n in (2, 3, 5):
        some = everyone[lengths >= n]
        head, tail = np.full(len(some), 101 + n, np.uint64), np.full(len(some), 201 + n, np.uint64)
        for j in range(n):
            head = mixed(head * np.uint64(257) + table[some, j])
            tail = mixed(tail * np.uint64(257) + table[some, lengths[some] - n + j])
        cols += [head, tail]
        rows += [some, some]
    return (np.concatenate(cols) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(rows), word_keys(table)


class Model:
    """Weights of a chain over `langs`: hashed features, lexicon log ratios, start and transition weights."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        L = len(langs)
        self.langs, self.weights = langs, np.zeros((BUCKETS, L), np.float32)
        counts = lexicon + 0.1 * lexicon.sum(axis=0, keepdims=True) / max(1.0, lexicon.sum())
        share = counts / np.maximum(lexicon.sum(axis=0, keepdims=True), 1.0)
        ratio = np.log(share + 1e-9)
        ratio -= ratio.mean(axis=1, keepdims=True)
        ratio[lexicon.sum(axis=1) == 0] = 0
        self.lexicon, self.scale = np.clip(ratio, -4, 4).astype(np.float32), np.full(L, 0.3, np.float32)
        self.start, self.moves = np.zeros(L), np.eye(L) * 3.0

    def emissions(self, words: list[bytes]) -> np.ndarray:
        """Score of each word for each language, features averaged over the square root of their number."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for i in range(0, len(words), 20_000):
            part = words[i : i + 20_000]
            cols, rows, lex = features(part)
            norm = 1 / np.sqrt(np.bincount(rows, minlength=len(part)))
            for k in range(out.shape[1]):
                out[i : i + len(part), k] = np.bincount(rows, self.weights[cols, k], len(part)) * norm + self.lexicon[lex, k] * self.scale[k]
        return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of all positions and summed pair posteriors; `scores` has the sequences one after the other.

    Sequences run side by side, the longest first, so that step t works on those that are longer than t; scaled
    probabilities stay within floating range at any length.
    """
    L = scores.shape[1]
    post, pairs = np.zeros((len(scores), L)), np.zeros((L, L))
    if not len(scores):
        return post, pairs
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    A, order = np.exp(moves - moves.max()), np.argsort(-lengths, kind="stable")
    first, n = (np.cumsum(lengths) - lengths)[order], lengths[order]
    steps = int(n[0])
    active = np.searchsorted(-n, -np.arange(steps), side="left")
    alpha = np.zeros_like(e)
    for t in range(steps):
        k = active[t]
        at = first[:k] + t
        a = e[at] * (np.exp(start - start.max()) if t == 0 else alpha[at - 1] @ A)
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    beta = np.ones((len(n), L))
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        p = alpha[at] * beta[:k]
        post[at] = p / p.sum(axis=1, keepdims=True)
        if t:
            x = e[at] * beta[:k]
            joint = alpha[at - 1][:, :, None] * A[None] * x[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = x @ A.T
            beta[:k] = b / b.sum(axis=1, keepdims=True)
    return post, pairs


def posteriors(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray, block: int = 64) -> np.ndarray:
    """Sum of the position posteriors of each sequence, as `forward_backward` gives them, in steps that do not grow with the longest
    sequence: sequences are cut into blocks, each block's product of transitions and emissions carries the messages across it,
    and then all blocks run side by side."""
    L = scores.shape[1]
    sums = np.zeros((len(lengths), L))
    if not len(scores):
        return sums
    A, first_message = np.exp(moves - moves.max()), np.exp(start - start.max())
    per = -(-lengths // block)
    doc = np.repeat(np.arange(len(lengths)), per)
    head = np.cumsum(per) - per
    number = np.arange(len(doc)) - np.repeat(head, per)
    size = np.minimum(block, lengths[doc] - number * block)
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(doc), np.int64)
    place[order] = np.arange(len(doc))
    at = ((np.cumsum(lengths) - lengths)[doc] + number * block)[order]
    size = size[order]
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    steps = [e[at[:k] + t] for t, k in enumerate(active)]

    through = np.broadcast_to(np.eye(L), (len(doc), L, L)).copy()
    for t, k in enumerate(active):
        x = through[:k] if t == 0 else (through[:k].reshape(-1, L) @ A).reshape(k, L, L)
        x = x * steps[t][:, None, :]
        through[:k] = x / x.sum(axis=(1, 2), keepdims=True)
    before, after = np.empty((len(doc), L)), np.ones((len(doc), L))
    longest = np.argsort(-per, kind="stable")
    waves = [longest[: int(np.searchsorted(-per[longest], -j, side="left"))] for j in range(int(per.max()))]
    for j, docs in enumerate(waves):
        here = place[head[docs] + j]
        if j == 0:
            before[here] = first_message
        else:
            last = place[head[docs] + j - 1]
            x = np.einsum("nl,nlm->nm", before[last], through[last]) @ A
            before[here] = x / x.sum(axis=1, keepdims=True)
    for j in range(len(waves) - 1, 0, -1):
        here, last = place[head[waves[j]] + j], place[head[waves[j]] + j - 1]
        x = np.einsum("nlm,nm->nl", through[here], after[here]) @ A.T
        after[last] = x / x.sum(axis=1, keepdims=True)

    alpha = []
    for t, k in enumerate(active):
        x = (before[:k] if t == 0 else alpha[-1][:k] @ A) * steps[t]
        alpha.append(x / x.sum(axis=1, keepdims=True))
    total, beta = np.zeros((len(doc), L)), after
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        p = alpha[t] * beta[:k]
        total[:k] += p / p.sum(axis=1, keepdims=True)
        x = (steps[t] * beta[:k]) @ A.T
        beta[:k] = x / x.sum(axis=1, keepdims=True)
    some = per > 0
    sums[some] = np.add.reduceat(total[place], head[some])
    return sums


def train(texts: list[bytes], labels: list[int], langs: list[str], lexicon: np.ndarray, rounds: int = 6, rate: float = 0.5,
          seed: int = 7) -> Model:
    """Maximum likelihood by AdaGrad over sequences of up to 60 words, half of which switch language once or twice. Their runs of 20 words are
    drawn at random over whole texts, TEXT_RUNS of a text and as many sequences begin with each language, LANGUAGE_RUNS at most."""
    rng, model = np.random.default_rng(seed), Model(langs, lexicon)
    runs = [[] for _ in langs]
    for text, y in zip(texts, labels):
        words = word_bytes(text)
        starts = np.arange(0, len(words), 20)
        if len(starts) > TEXT_RUNS:
            starts = np.sort(rng.choice(starts, TEXT_RUNS, replace=False))
        runs[y] += [words[i : i + 20] for i in starts]
    some = [y for y in range(len(langs)) if runs[y]]
    if not some:
        return model
    sequences = []
    firsts = min(LANGUAGE_RUNS, max(map(len, runs)))
    for y in some:
        for i in np.resize(rng.permutation(len(runs[y])), firsts):
            parts = [(runs[y][i], y)]
            while rng.random() < 0.5 and len(parts) < 3 and len(some) > 1:
                z = int(rng.choice(some))
                parts.append((runs[z][int(rng.integers(len(runs[z])))], z))
            sequences.append(([w for p, _ in parts for w in p], [k for p, k in parts for _ in p]))
    L, grad2 = len(langs), np.full((BUCKETS, len(langs)), 1e-3)
    scale2, start2, moves2 = np.full(L, 1e-3), np.full(L, 1e-3), np.full((L, L), 1e-3)
    for _ in range(rounds):
        rng.shuffle(sequences)
        for i in range(0, len(sequences), 200):
            part = sequences[i : i + 200]
            words, gold = [w for s, _ in part for w in s], np.array([k for _, y in part for k in y])
            lengths = np.array([len(s) for s, _ in part])
            cols, rows, lex = features(words)
            norm = 1 / np.sqrt(np.bincount(rows, minlength=len(words)))
            post, pairs = forward_backward(model.emissions(words), lengths, model.start, model.moves)
            diff = np.eye(L)[gold] - post
            ends = np.cumsum(lengths)
            inner = np.ones(len(words), bool)
            inner[ends - lengths] = False
            seen = np.zeros((L, L))
            np.add.at(seen, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
            n = len(words)
            g = np.zeros((BUCKETS, L))
            for k in range(L):
                g[:, k] = np.bincount(cols, (diff[:, k] * norm)[rows], BUCKETS) / n
            g -= 1e-6 * model.weights
            grad2 += g * g
            model.weights += (rate * g / np.sqrt(grad2)).astype(np.float32)
            for what, g, total in (("scale", (diff * model.lexicon[lex]).sum(axis=0) / n, scale2), ("moves", (seen - pairs) / n, moves2),
                                   ("start", diff[ends - lengths].sum(axis=0) / len(part), start2)):
                total += g * g
                setattr(model, what, (getattr(model, what) + 0.3 * rate * g / np.sqrt(total)).astype(getattr(model, what).dtype))
    return model


def lexicon_counts(docs: DataFrame, langs: list[str]) -> np.ndarray:
    """Counts of hashed words by language over all labelled rows (columns text, lang), summed within tasks first. The table has
    LEXICON rows for each language, whatever the corpus."""
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), LEXICON), np.int64)
        for b in batches:
            found = [Counter() for _ in langs]
            for text, lang in zip(column_bytes(b, "text"), b.column(1).to_pylist()):
                found[index[lang]].update(word_bytes(text))
            for k, words in enumerate(found):
                for part in slices(len(words), 20_000):
                    some = list(words)[part]
                    np.add.at(total[k], word_keys(char_table(some)[0]), np.array(list(words.values())[part], np.int64))
        k, bucket = np.nonzero(total)
        yield record({"k": k, "bucket": bucket, "n": total[k, bucket]}, {"k": pa.int32(), "bucket": pa.int32(), "n": pa.int64()})

    found = docs.select(text_bytes().alias("text"), "lang").mapInArrow(run, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    out = np.zeros((LEXICON, len(langs)))
    out[found.bucket, found.k] = found.n
    return out


def fit(docs: DataFrame, training: Column, id_col: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Learn from the rows where `training` holds and lang is not null: lexicon counts from all of them, chain weights from about
    `sample` of them in even parts for each language, but LEAST_ROWS of each that has so many, chosen by a hash of id and text (a documented
    bound; at most twice that many reach the driver)."""
    arrow_batches(docs.sparkSession)
    rows = docs.where(training & F.col("lang").isNotNull()).select(F.col(id_col).alias("doc_id"), "text", "lang")
    by_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(by_lang)
    if not langs:
        return Model(["und"], np.zeros((LEXICON, 1)))
    quota = max(LEAST_ROWS, -(-sample // len(langs)))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")), F.lit(11)), F.lit(1 << 40))
    below = F.create_map(*[F.lit(x) for k in langs for x in (k, math.ceil((1 << 40) * min(1.0, quota / by_lang[k])))])
    drawn = rows.select(text_bytes().alias("text"), "lang", draw.alias("draw")).where(F.col("draw") < F.element_at(below, F.col("lang")))
    lexicon = lexicon_counts(rows, langs)
    some = drawn.limit(2 * quota * len(langs)).toArrow()
    some = some.take(pc.sort_indices(some, [("draw", "ascending")]))
    texts, labels = some.column("text").to_pylist(), [langs.index(x) for x in some.column("lang").to_pylist()]
    del some
    return train(texts, labels, langs, lexicon)


def annotate(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with __lang_pred, __lang_score and __n_words of every row, from its whole text.

    The score is the share of the predicted language in the words' posteriors. Null text and text without letters give `und` and
    score 0. Repeated rows give a row each, null ids are passed on, ties go to the first language by name. Empty input gives no rows;
    extra columns pass through.
    """
    sent = shipped(docs.sparkSession, model)

    def start():
        m, known = sent(), {}
        table = np.zeros((1024, len(m.langs)), np.float32)

        def score(texts: list[bytes]) -> dict:
            nonlocal known, table
            words = [word_bytes(t) for t in texts]
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            flat = [w for t in words for w in t]
            if len(known) > 300_000:
                known = {}
            new = [w for w in dict.fromkeys(flat) if w not in known]
            if new:
                need = len(known) + len(new)
                if need > len(table):
                    table = np.concatenate([table[: len(known)], np.zeros((2 * need - len(known), len(m.langs)), np.float32)])
                table[len(known) : need] = m.emissions(new)
                known.update(zip(new, range(len(known), need)))
            idx = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
            sums = posteriors(table[idx], lengths, m.start, m.moves)
            share = np.where(lengths > 0, np.clip(sums.max(axis=1) / np.maximum(lengths, 1), 0, 1), 0.0)
            return {"__lang_pred": [m.langs[k] if n else "und" for k, n in zip(sums.argmax(axis=1), lengths)], "__lang_score": share, "__n_words": lengths}

        return score

    return add_columns(docs, text_col, start, {"__lang_pred": "string", "__lang_score": "double", "__n_words": "long"}, keep)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_words) of every row; see `annotate`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(rows, model, "text", ["doc_id"]).toDF("doc_id", "lang_pred", "score", "n_words")

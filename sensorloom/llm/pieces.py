"""N best segmentations of texts into the pieces of a given vocabulary, and decoding.

The lattice of a text has an edge for every piece that matches somewhere. A forward Viterbi pass gives the best score from the start to
every place; a search from the end backwards takes these scores as exact heuristics (A-star), so it meets complete
segmentations in order of score. The lattice falls apart wherever no piece crosses: before a word's start, and between characters that no
piece has side by side (letters and marks, say). Each distinct part is searched once, and the best segmentations of the text are merged from
those of its parts.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Places, arrow_batches, column_bytes, record, text_bytes, worker_cache

SPACE = "▁"
#: Characters by which the pieces that match at a place are remembered, and how many such beginnings are kept.
HEAD, HEADS = 4, 200_000
ROW = {"doc_id": pa.int64(), "rank": pa.int32(), "score": pa.float64(), "n_pieces": pa.int64(), "ids_crc32": pa.int64(), "round_trip": pa.bool_(),
       "ids": pa.list_(pa.int32())}


class Lattice:
    """Pieces with their scores. A character that no piece covers is spelled by its byte pieces, at a score below that of every piece."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int] | None = None, unknown: int = 0):
        self.pieces, self.byte_ids, self.unknown = {p: (s, (i,)) for p, (i, s) in pieces.items()}, byte_ids or {}, unknown
        #: Proper beginnings of pieces: a match can go on only from these.
        self.prefixes = {p[:i] for p in pieces for i in range(1, len(p))}
        self.longest = max(map(len, pieces), default=1)
        self.penalty = min((s for _, s in pieces.values()), default=0.0) - 10
        self.names = {i: p for p, (i, _) in pieces.items()}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        #: Characters that some piece has before a word's start; words are not cut after them.
        self.sticky = {a for p in pieces for a, b in zip(p, p[1:]) if b == SPACE}
        self.parts = None if self.sticky - {SPACE} else self.uncrossed()
        self.heads: dict[str, tuple[list, bool]] = {}

    def uncrossed(self) -> re.Pattern:
        """Pattern of the parts that no piece crosses. Characters that some piece has side by side are of one group, and so are those they lead
        to; a part is a run of one group, with the word starts before it, or a single character of none."""
        group: dict[str, str] = {}

        def root(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        for p in self.pieces:
            bare = p.replace(SPACE, "")
            for a, b in zip(bare, bare[1:]):
                group[root(a)] = root(b)
        runs: dict[str, str] = {}
        for c in group:
            runs[root(c)] = runs.get(root(c), "") + re.escape(c)
        kinds = "|".join(f"[{r}]+" for r in sorted(runs.values(), key=len, reverse=True))
        return re.compile(f"{SPACE}*(?:{kinds + '|' if kinds else ''}[^{SPACE}])|{SPACE}+", re.DOTALL)

    @classmethod
    def load(cls, path: str) -> Lattice:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found, spelled = {}, {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                spelled[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                found[model.id_to_piece(i)] = (i, float(model.get_score(i)))
        return cls(found, spelled, model.unk_id())

    def words(self, text: str) -> list[str]:
        """Parts that no piece crosses of a text with a leading word start. An empty text has none."""
        if not text:
            return []
        parts = text.replace(" ", SPACE).split(SPACE)
        out: list[str] = []
        if self.parts is None:
            for part in parts:
                if out and out[-1][-1] in self.sticky:
                    out[-1] += SPACE + part
                else:
                    out.append(SPACE + part)
            return out
        held = SPACE
        for part in parts:
            if part.isalpha():
                out.append(held + part)
                held = SPACE
            elif part:
                out += self.parts.findall(held + part)
                held = SPACE
            else:
                held += SPACE
        if len(held) > 1:
            out.append(held[1:])
        return out

    def begins(self, head: str) -> tuple[list[tuple[int, float, tuple[int, ...]]], bool]:
        """(length, score, ids) of the pieces that match at the start of `head`, and whether longer ones may."""
        found = []
        for end in range(1, len(head) + 1):
            part = head[:end]
            hit = self.pieces.get(part)
            if hit is not None:
                found.append((end, *hit))
            elif end == 1:
                spelled = part.encode("utf-8", "replace")
                found.append((1, self.penalty, tuple(self.byte_ids.get(b, self.unknown) for b in spelled) if self.byte_ids else (self.unknown,)))
            if part not in self.prefixes:
                return found, False
        return found, True

    def n_best(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to n best segmentations, best first. Of equal scores the search follows the one nearest to the start, so runs of one
        character, which have countless equal segmentations, cost no more than others. The best way on from a place is followed at once; the
        others are kept if fewer than n - 1 of those met so far are better."""
        size, heads, pieces, prefixes = len(word), self.heads, self.pieces, self.prefixes
        if len(heads) > HEADS:
            heads.clear()
        into: list[list] = [[] for _ in range(size + 1)]
        best = [0.0] + [-np.inf] * size
        for start in range(size):
            here, head = best[start], word[start : start + HEAD]
            known = heads.get(head)
            if known is None:
                known = heads[head] = self.begins(head)
            for length, score, ids in known[0]:
                end = start + length
                into[end].append((start, score, ids))
                if here + score > best[end]:
                    best[end] = here + score
            if known[1]:
                for end in range(start + HEAD + 1, min(size, start + self.longest) + 1):
                    part = word[start:end]
                    hit = pieces.get(part)
                    if hit is not None:
                        into[end].append((start, *hit))
                        if here + hit[0] > best[end]:
                            best[end] = here + hit[0]
                    if part not in prefixes:
                        break
        push, pop, count = heapq.heappush, heapq.heappop, 0
        heap, others, out = [(-best[-1], size, 0, 0.0, None)], [], []
        while heap and len(out) < n:
            _, at, _, behind, path = pop(heap)
            while at:
                first = None
                for start, score, ids in into[at]:
                    score += behind
                    now = (best[start] + score, start, score, ids)
                    if first is None:
                        first = now
                        continue
                    if now[0] > first[0]:
                        first, now = now, first
                    bound = now[0]
                    if len(others) < n - 1:
                        push(others, bound)
                    elif not others or bound < others[0]:
                        continue
                    else:
                        heapq.heapreplace(others, bound)
                    count += 1
                    push(heap, (-bound, now[1], count, now[2], (now[3], path)))
                _, at, behind, ids = first
                path = (ids, path)
            found: list[int] = []
            while path:
                found += path[0]
                path = path[1]
            out.append((behind, tuple(found)))
        return out

    def decode(self, ids) -> str:
        """Text of a row of ids: the leading word start goes, further ones become spaces, and byte pieces are put together."""
        return self.joined(ids)[1:]

    def joined(self, ids) -> str:
        out, held = [], bytearray()
        for i in ids:
            i = int(i)
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.names.get(i, ""))
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")


class Words:
    """N best segmentations of the words met so far, in flat arrays; emptied at `limit` words, which changes no result."""

    def __init__(self, lattice: Lattice, n: int, limit: int = 1_000_000):
        self.lattice, self.n, self.limit = lattice, n, limit
        self.clear()

    def clear(self) -> None:
        self.index, self.used = Places(), 0
        self.scores, self.start, self.length = np.zeros((1024, self.n)), np.zeros((1024, self.n), np.int64), np.zeros((1024, self.n), np.int32)
        self.whole, self.pool = np.zeros(1024, bool), np.zeros(4096, np.int32)

    def _grow(self, name: str, need: int) -> None:
        old = getattr(self, name)
        if need > len(old):
            new = np.zeros((max(need, 2 * len(old)), *old.shape[1:]), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def places(self, words: list[str]) -> np.ndarray:
        if len(self.index) > self.limit:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if new := self.index.new:
            first = len(self.index) - len(new)
            for name in ("scores", "start", "length", "whole"):
                self._grow(name, len(self.index))
            scores: list[float] = []
            lengths: list[int] = []
            pool: list[int] = []
            for word in new:
                found = self.lattice.n_best(word, self.n)
                for s, ids in found:
                    scores.append(s)
                    lengths.append(len(ids))
                    pool += ids
                if rest := self.n - len(found):
                    scores += [-np.inf] * rest
                    lengths += [0] * rest
                self.whole[first] = self.spells(found[0][1], word)
                first += 1
            here, sizes = slice(first - len(new), first), np.array(lengths, np.int64)
            self.scores[here] = np.array(scores).reshape(-1, self.n)
            self.length[here] = sizes.reshape(-1, self.n)
            self.start[here] = (self.used + np.cumsum(sizes) - sizes).reshape(-1, self.n)
            self._grow("pool", self.used + len(pool))
            self.pool[self.used : self.used + len(pool)] = pool
            self.used += len(pool)
            new.clear()
        return at

    def spells(self, ids, word: str) -> bool:
        """Whether the ids decode to the word with its leading word start as a space. All segmentations of a word cover the same characters."""
        names = self.lattice.names
        return "".join([names.get(i, "") for i in ids]) == word or self.lattice.joined(ids) == word.replace(SPACE, " ")

    def best_ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentations of words in a row, and where each word's ids begin."""
        n = self.length[places, 0].astype(np.int64)
        before = np.cumsum(n) - n
        return self.pool[np.repeat(self.start[places, 0] - before, n) + np.arange(int(n.sum()))], before


def merged(scores: np.ndarray, n: int) -> list[tuple[float, dict[int, int]]]:
    """The n best ways to choose one option for each row of `scores` (best first in each row), as (loss, {row: option}). Only the n - 1 rows of
    the smallest first losses can differ from their best option in any of them."""
    some = np.zeros(0, np.int64)
    if n > 1 and len(scores):
        first = scores[:, 0] - scores[:, 1]
        near = np.flatnonzero(first <= np.partition(first, n - 2)[n - 2]) if len(first) >= n else np.arange(len(first))
        some = near[np.argsort(first[near], kind="stable")][: n - 1]
        some = some[np.isfinite(first[some])]
    loss = (scores[some, :1] - scores[some]).tolist()
    heap, seen, out = [(0.0, (0,) * len(some))], {(0,) * len(some)}, []
    while heap and len(out) < n:
        total, choice = heapq.heappop(heap)
        out.append((total, {int(some[i]): c for i, c in enumerate(choice) if c}))
        for i, c in enumerate(choice):
            if c + 1 < scores.shape[1] and loss[i][c + 1] < np.inf:
                other = choice[:i] + (c + 1,) + choice[i + 1 :]
                if other not in seen:
                    seen.add(other)
                    heapq.heappush(heap, (sum([loss[j][k] for j, k in enumerate(other)]), other))
    return out


def segment(docs: DataFrame, vocabulary: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Up to n best segmentations of every whole text: doc_id, rank (from 1), score, n_pieces, ids_crc32, round_trip (and ids).

    The score is the sum of the vocabulary's own scores; round_trip tells whether decoding gives the text back. Null and empty texts have the
    one segmentation without pieces. A word has at most as many segmentations as its lattice allows. Repeated rows give their rows each, null ids
    are passed on, equal texts have equal rows. Empty input gives no rows; other columns are ignored.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_cache(f"pieces_{n}_" + "".join(c if c.isalnum() else "_" for c in vocabulary), lambda: Words(Lattice.load(vocabulary), n))
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), column_bytes(b, "text")):
                plain = text.decode("utf-8", "replace")
                at = words.places(words.lattice.words(plain))
                ids, begins = words.best_ids(at)
                best, whole = float(words.scores[at, 0].sum()), bool(words.whole[at].all()) and SPACE not in plain
                for rank, (loss, other) in enumerate(merged(words.scores[at], n), 1):
                    chosen = ids
                    for row in sorted(other, reverse=True):
                        place, k = at[row], other[row]
                        s, e = begins[row], begins[row] + words.length[place, 0]
                        swap = words.pool[words.start[place, k] : words.start[place, k] + words.length[place, k]]
                        chosen = np.concatenate([chosen[:s], swap, chosen[e:]])
                    rows.append((key, rank, best - loss, len(chosen), zlib.crc32(chosen.astype("<u4").tobytes()), whole, chosen if with_ids else None))
            if rows:
                yield record(dict(zip(ROW, zip(*rows))), ROW)

    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text")).mapInArrow(
        run, "doc_id long, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean, ids array<int>")
    return out if with_ids else out.drop("ids")


def decoded(segmentations: DataFrame, vocabulary: str) -> DataFrame:
    """Rows of `segment` (with ids) and the text that each decodes to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = worker_cache("lattice_" + "".join(c if c.isalnum() else "_" for c in vocabulary), lambda: Lattice.load(vocabulary))
        for b in batches:
            texts = [lattice.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("rank"), pa.array(texts, pa.string())], names=["doc_id", "rank", "text"])

    return segmentations.select("doc_id", "rank", "ids").mapInArrow(run, "doc_id long, rank int, text string")

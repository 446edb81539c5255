"""Alignment of two tokenizers: byte-level BPE tokens (A) and sentencepiece tokens (B) of the same text, cut where both end.

The spans that the two libraries give are coarse cuts in characters. Tokens inside one character (parts of a multibyte character, byte
fallback) share or lack a span there; their ends are refined with the bytes that the tokens decode to. Both tokenizers always cut before
a single space between two other characters, so a text is aligned in segments that begin with such a space, each distinct segment once.

Two linked tokens end at the same byte, so the bytes of one are a suffix of the other's. The vocabularies therefore allow no more different
pairs than they have bytes, whatever the corpus: that bounds the table of pair counts that is sent to the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Places, arrow_batches, column_bytes, record, shipped, slices, text_bytes, worker_cache

CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space on either side of a space, where the text is not cut.
BESIDE = re.compile(r" \s"), re.compile(r"[^\S ] ")
PIECES = 1 << 20
#: The cache of segments is emptied beyond so many, or beyond so many bytes of them, or twice as many without their groups; that changes no result.
SEGMENTS, SEGMENT_BYTES = 500_000, 32 << 20


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes of Latin-1 are themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def piece_bytes(piece: str) -> bytes:
    fallback = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(fallback[1], 16)]) if fallback else piece.replace("▁", " ").encode()


class Vocabulary:
    """Bytes of the tokens of one vocabulary, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        return self.pool[np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted keys (A id * PIECES + B id) of all pairs of which one's bytes end with the other's."""
    of_a, of_b = {}, {}
    for found, tokens in ((of_a, a), (of_b, b)):
        for i, t in enumerate(tokens):
            if t:
                found.setdefault(t, []).append(i)
    keys = [x * PIECES + y for t, same in of_b.items() for k in range(len(t)) for x in of_a.get(t[k:], ()) for y in same]
    keys += [x * PIECES + y for t, same in of_a.items() for k in range(1, len(t)) for y in of_b.get(t[k:], ()) for x in same]
    return np.array(sorted(keys), np.int64)


def refined(begin: np.ndarray, end: np.ndarray, last: np.ndarray, byte_of: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from their spans in characters. A span that is not empty and meets the next one is a cut; between cuts the
    lengths of the decoded bytes count on from the last one. `last` marks the last token of each segment, which ends it."""
    clean = last.copy()
    clean[:-1] |= (end[:-1] == begin[1:]) & (end[:-1] > begin[:-1])
    total, coarse = np.cumsum(lengths), byte_of[end]
    anchor = np.maximum.accumulate(np.where(clean, np.arange(len(end)), -1))
    from_cut = np.where(anchor >= 0, coarse[anchor] - total[anchor], 0) + total
    return np.where(clean, coarse, from_cut)


class Aligner:
    """Both tokenizers, and the alignment of the segments seen so far."""

    def __init__(self, byte_level: str, pieces: str, segments: int = SEGMENTS, group: int = 64):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        special = {i for i, t in self.a.get_added_tokens_decoder().items()}
        tokens_a = [bytes(alphabet[c] for c in names[i]) if i in names and i not in special else b"" for i in range(1 + max(max(names), *special, 0))]
        count = self.b.get_piece_size()
        tokens_b = [b"" if self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i) else piece_bytes(self.b.id_to_piece(i)) for i in range(count)]
        #: Without pieces that hold a space after another character, no piece reaches over a cut.
        self.cuts = all(b" " not in t.lstrip(b" ") for t in tokens_b)
        self.of_a, self.of_b = Vocabulary(tokens_a), Vocabulary(tokens_b)
        self.pairs = possible_pairs(tokens_a, tokens_b)
        self.limit, self.group = segments, group if self.cuts else 1
        self.names = [str(i) for i in range(max(len(tokens_a), count))]
        self.clear()

    def clear(self, with_groups: bool = True) -> None:
        self.with_groups = with_groups
        self.index, self.groups, self.bytes = Places(), [], 0
        self.n_a = self.n_b = self.n_links = np.zeros(0, np.int64)
        self.good, self.links = np.zeros(0, bool), np.zeros(0, np.int32)

    def segments(self, text: str) -> list[str]:
        if not self.cuts or not text:
            return [text] if text else []
        plain = text[0] != " " and text[-1] != " " and not BESIDE[0].search(text) and not BESIDE[1].search(text)
        return text.split(" ") if plain else CUT.split(text)

    def ends(self, texts: list[str]) -> tuple:
        """For texts one after another: ids and byte ends of the A tokens, then of the B tokens, each with its text, and which texts both decode to.
        Bytes are counted over all texts, each with its leading space."""
        raw = [b" " + s.encode() for s in texts]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        size = np.array([len(r) for r in raw], np.int64)
        first_byte = np.cumsum(size) - size
        starts = np.flatnonzero((flat & 0xC0) != 0x80)
        byte_of, first_char = np.append(starts, len(flat)), np.searchsorted(starts, first_byte)
        good, out = np.ones(len(texts), bool), []
        made_a = self.a.encode_batch([" " + s for s in texts], add_special_tokens=False)
        made_b = self.b.encode(texts, return_type="offset_mapping", num_threads=1)
        for ids, spans, shift, words in (([x.ids for x in made_a], (x.offsets for x in made_a), 0, self.of_a), ([x["ids"] for x in made_b], (x["offsets"] for x in made_b), 1, self.of_b)):
            count = np.array([len(x) for x in ids], np.int64)
            flat_ids = np.fromiter(chain.from_iterable(ids), np.int64, int(count.sum()))
            flat_spans = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * len(flat_ids)).reshape(-1, 2) + shift
            text = np.repeat(np.arange(len(texts)), count)
            last = np.zeros(len(flat_ids), bool)
            last[np.cumsum(count)[count > 0] - 1] = True
            lengths = words.length[flat_ids]
            decoded = np.bincount(text, lengths, len(texts)).astype(np.int64)
            fits = decoded == size
            if fits.all():
                unlike = words.decode(flat_ids) != flat
                fits[np.repeat(np.arange(len(texts)), size)[unlike]] = False
            else:
                for i in np.flatnonzero(fits):
                    fits[i] = b"".join([words.tokens[t] for t in ids[i]]) == raw[i]
            good &= fits
            at = flat_spans + first_char[text][:, None]
            found = refined(at[:, 0], at[:, 1], last, byte_of, lengths) if len(flat_ids) else np.zeros(0, np.int64)
            # The decoded bytes have the last word where a span is not what it should be.
            exact = np.cumsum(lengths) - (np.cumsum(decoded) - decoded)[text] + first_byte[text]
            out += [flat_ids, np.where(fits[text], exact, found), text]
        return (*out, good)

    def joined_ends(self, segments: list[str]) -> tuple:
        """Ids and byte ends (over all segments) of the A tokens and of the B tokens, and which segments both decode to. Segments are encoded many at
        a time, as texts that are cut again; alone stay those with white space at an end, where no cut would be, and those of a text that does not come back."""
        size = np.array([1 + len(s.encode()) for s in segments], np.int64)
        start, good = np.cumsum(size) - size, np.ones(len(segments), bool)
        odd = np.array([s[0].isspace() or s[-1].isspace() for s in segments])
        begins = np.flatnonzero((np.arange(len(segments)) % self.group == 0) | odd | np.append(False, odd[:-1])).tolist()
        parts = list(map(slice, begins, [*begins[1:], len(segments)]))
        a, a_end, a_in, b, b_end, b_in, fits = self.ends([" ".join(segments[p]) for p in parts])
        if fits.all():
            return a, a_end, b, b_end, good
        alone = [i for p, ok in zip(parts, fits) if not ok for i in range(p.start, p.stop)]
        x, x_end, x_in, y, y_end, y_in, single = self.ends([segments[i] for i in alone])
        good[[i for i, ok in zip(alone, single) if not ok]] = False
        move = start[alone] - (np.cumsum(size[alone]) - size[alone])
        out = []
        for ids, end, text, more, more_end, more_in in ((a, a_end, a_in, x, x_end, x_in), (b, b_end, b_in, y, y_end, y_in)):
            some, other = fits[text], single[more_in]
            ids, end = np.concatenate([ids[some], more[other]]), np.concatenate([end[some], (more_end + move[more_in])[other]])
            order = np.argsort(end, kind="stable")
            out += [ids[order], end[order]]
        return (*out, good)

    def learn(self, segments: list[str]) -> None:
        for part in slices(len(segments), 20_000):
            some = segments[part]
            a, a_end, b, b_end, good = self.joined_ends(some)
            stop = np.cumsum([1 + len(s.encode()) for s in some])
            a_in, b_in = np.searchsorted(stop, a_end), np.searchsorted(stop, b_end)
            at_end = np.full(int(stop[-1]) + 1, -1)
            at_end[b_end] = np.arange(len(b))
            both = at_end[a_end]
            hit = both >= 0
            place = np.searchsorted(self.pairs, a[hit] * PIECES + b[both[hit]])
            count_a, count_b, count = (np.bincount(x, minlength=len(some)) for x in (a_in, b_in, a_in[hit]))
            self.n_a, self.n_b, self.n_links = (np.concatenate([x, y]) for x, y in ((self.n_a, count_a), (self.n_b, count_b), (self.n_links, count)))
            self.good, self.links = np.concatenate([self.good, good]), np.concatenate([self.links, place.astype(np.int32)])
            self.bytes += int(stop[-1])
            if not self.with_groups:
                continue
            names_a, names_b = ([self.names[i] for i in x.tolist()] for x in (a, b))
            x = y = 0
            texts = []
            for p, q in zip((np.flatnonzero(hit) + 1).tolist(), (both[hit] + 1).tolist()):
                texts.append(f"{','.join(names_a[x:p])}|{','.join(names_b[y:q])}" if p - x > 1 or q - y > 1 else f"{names_a[x]}|{names_b[y]}")
                x, y = p, q
            at = 0
            for n in count.tolist():
                self.groups.append(";".join(texts[at : at + n]))
                at += n

    def places(self, texts: list[bytes], with_groups: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Place of each segment of the texts, and the number of segments of each text; -1 for a text that is not UTF-8. Only `with_groups` are the groups of ids
        made."""
        times = 1 if with_groups else 2
        if len(self.index) > times * self.limit or self.bytes > times * SEGMENT_BYTES or self.with_groups != with_groups:
            self.clear(with_groups)
        flat, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            try:
                found = self.segments(text.decode())
            except UnicodeDecodeError:
                counts[i] = -1
                continue
            counts[i] = len(found)
            flat += found
        places = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        if self.index.new:
            self.learn(self.index.new)
            self.index.new.clear()
        return places, counts


def aligner(byte_level: str, pieces: str) -> Aligner:
    name = "aligner_" + "".join(c if c.isalnum() else "_" for c in byte_level + pieces)
    return worker_cache(name, lambda: Aligner(byte_level, pieces))


def by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, `counts` of them for each text."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - counts]


def pair_counts(docs: DataFrame, byte_level: str, pieces: str, text_col: str = "text") -> DataFrame:
    """(pair, n): how often each possible pair (its place in `possible_pairs`) is linked in all texts. At most as many rows as there are possible pairs."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_level, pieces)
        total = np.zeros(len(tool.pairs), np.int64)
        for b in batches:
            places, counts = tool.places(column_bytes(b, "text"), with_groups=False)
            n = np.maximum(counts, 0)
            bad = by_text(~tool.good[places], n) > 0
            used = np.bincount(places[~np.repeat(bad, n)], minlength=len(tool.good))
            total += np.bincount(tool.links, np.repeat(used, tool.n_links), len(total)).astype(np.int64)
        some = np.flatnonzero(total)
        for part in slices(len(some), 50_000):
            yield record({"pair": some[part], "n": total[some[part]]}, {"pair": pa.int32(), "n": pa.int64()})

    return docs.select(text_bytes(text_col).alias("text")).mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


class Counts:
    """Count of each possible pair, and which pairs have the highest count of their B id."""

    def __init__(self, pairs: np.ndarray, place: np.ndarray, n: np.ndarray):
        self.n = np.zeros(len(pairs), np.int64)
        self.n[place] = n
        piece = pairs % PIECES
        most = np.zeros(PIECES, np.int64)
        np.maximum.at(most, piece, self.n)
        self.best = (self.n > 0) & (self.n == most[piece])


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and `groups` of every row: ids of A and B between common ends, as `a1,a2|b1;a3|b2`.

    A links to B where both end at the same byte; n_best counts links whose pair is linked most often in the corpus among pairs of that B id, count_sum
    adds the corpus counts of the links. Texts that are null, empty, not UTF-8, or that either tokenizer does not give back byte for byte have no
    tokens: zeros, and an empty `groups`; they count in no pair. Repeated rows count and return once each; a null id is passed on. An empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    counted = pair_counts(docs, byte_level, pieces, text_col).toArrow()
    sent = shipped(spark, (counted.column("pair").to_numpy(), counted.column("n").to_numpy()))
    numbers = ("n_a", "n_b", "n_links", "n_best", "count_sum")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_level, pieces)
        counts = Counts(tool.pairs, *sent())
        held, best, summed = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            places, count = tool.places(column_bytes(b, "text"))
            if held is not tool.index:
                held, best, summed = tool.index, np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(best) < len(tool.good):
                new = tool.n_links[len(best) :]
                links = tool.links[len(tool.links) - int(new.sum()) :]
                best, summed = (np.concatenate([x, by_text(y[links], new)]) for x, y in ((best, counts.best), (summed, counts.n)))
            n = np.maximum(count, 0)
            fine = (by_text(~tool.good[places], n) == 0) & (count >= 0)
            made = {k: by_text(v[places], n) * fine for k, v in zip(numbers, (tool.n_a, tool.n_b, tool.n_links, best, summed))}
            ends = np.cumsum(n)
            texts = [";".join([tool.groups[i] for i in places[e - k : e].tolist()]) if ok else "" for e, k, ok in zip(ends.tolist(), n.tolist(), fine.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(made[k], pa.int64()) for k in ("n_a", "n_b", "n_links", "n_links", "n_best", "count_sum")), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def digest(found: DataFrame) -> DataFrame:
    """The numbers of `align`, with a hash in place of the groups; '' where there are no tokens."""
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.when(F.col("n_groups") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256"))

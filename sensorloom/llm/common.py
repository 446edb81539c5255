"""Helpers shared by the operators: Arrow batches, caches of Python workers, scratch tables, split rules."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder

ROWS_PER_BATCH, BYTES_PER_BATCH = 1000, 32 << 20
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Small Arrow batches, so that a task holds about a thousand texts at a time, however long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def split_number(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(parts)), F.lit(0)).cast("int")


def quoted(names: list[str]) -> list[Column]:
    """Columns by their exact names, also where a name has dots."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a table in the cluster's shared scratch folder and read it back: expensive input is computed once and
    survives lost executors."""
    path = scratch_folder(df.sparkSession) + "/table"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(name: str, make: Callable):
    """An object kept for the life of a Python worker, so that later tasks of that worker find it again."""
    store = sys.modules.setdefault("_sensorloom_worker", types.ModuleType("_sensorloom_worker"))
    found = getattr(store, name, None)
    if found is None:
        found = make()
        setattr(store, name, found)
    return found


def shipped(spark: SparkSession, model) -> Callable:
    """A model of bounded size for the tasks: a function that gives it there. Its class travels with it."""
    import pickle

    from pyspark import cloudpickle

    sent = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    return lambda: pickle.loads(sent.value)


def learned(sample: DataFrame, learn: Callable[..., dict]) -> dict:
    """What `learn` makes of the columns (lists) of a sample of bounded size, in a task: the sample never reaches the driver, its result does."""
    import pickle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in sample_columns]
        for b in batches:
            for values, column in zip(columns, b.columns):
                values += column.to_pylist()
        yield record({"model": [pickle.dumps(learn(*columns))]}, {"model": pa.binary()})

    sample_columns = sample.columns
    found = sample.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else learn(*[[] for _ in sample_columns])


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """Values of a text or binary column as bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    column = column if pa.types.is_binary(column.type) else column.cast(pa.binary())
    return [x if x is not None else b"" for x in column.to_pylist()]


def add_columns(docs: DataFrame, text_col: str, start: Callable[[], Callable[[list[bytes]], dict]], fields: dict[str, str],
                keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of `docs` (all, if not given) and the `fields` (name to SQL type) that a function makes from each batch of texts.

    `start` is called once in each task and returns that function. Extra columns of any type and name pass through untouched.
    """
    arrow_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    names = keep if text_col in keep else [*keep, text_col]
    at, plain = names.index(text_col), [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*quoted(names)).toDF(*[f"c{i}" for i in range(len(names))])
    types_ = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "int": pa.int32()}
    schema = T.StructType([*rows.select(*plain).schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = start()
        for b in batches:
            made = score(column_bytes(b, f"c{at}"))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *(pa.array(made[n], types_[t]) for n, t in fields.items())],
                                             names=[*plain, *fields])

    return rows.mapInArrow(run, schema).toDF(*keep, *fields)


def record(arrays: dict, types_: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(arrays[k], t) for k, t in types_.items()], names=list(types_))


def slices(n: int, size: int) -> Iterator[slice]:
    return (slice(i, min(n, i + size)) for i in range(0, n, size))


class Places(dict):
    """Place of each word; a word that is looked up for the first time gets the next place and is listed in `new`."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordIds:
    """Token ids of words, each word encoded once per worker; ids of a text are gathered from the pool of its words.

    White space never belongs to a token of the vocabulary and always separates words, so a text's ids are the ids of
    its words in turn. Case is ignored by the vocabulary, so words are looked up in lower case. The cache is emptied
    when it holds `limit` words, which bounds its memory and changes no result.
    """

    def __init__(self, path: str, limit: int = 1_000_000, group: int = 256):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.group = Tokenizer.from_file(path), limit, group
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(1 + max(vocabulary.values()), bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.index = Places()
        self.start, self.length, self.pool, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(4096, np.uint16), 0

    def _grow(self, name: str, need: int) -> None:
        old = getattr(self, name)
        if need > len(old):
            new = np.zeros(max(need, 2 * len(old)), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def _put(self, places: list[int], lengths: np.ndarray, ids: np.ndarray) -> None:
        self._grow("pool", self.used + len(ids))
        self.start[places] = self.used + np.cumsum(lengths) - lengths
        self.length[places] = lengths
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _encode(self, places: list[int], words: list[str]) -> None:
        """Words of letters alone are encoded in groups, as each of them ends with the one closing token of its group of ids; if the
        closing tokens of a group do not match its words, and for other words, each word is encoded by itself."""
        alone = [i for i, w in enumerate(words) if not w.isalpha()]
        letters = [i for i, w in enumerate(words) if w.isalpha()]
        groups = [letters[part] for part in slices(len(letters), self.group)]
        for found, group in zip(self.tokenizer.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False), groups):
            ids = np.array(found.ids, np.uint16)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                self._put([places[i] for i in group], np.diff(ends, prepend=0), ids)
            else:
                alone += group
        for part in slices(len(alone), 20_000):
            ids = [x.ids for x in self.tokenizer.encode_batch_fast([words[i] for i in alone[part]], add_special_tokens=False)]
            self._put([places[i] for i in alone[part]], np.fromiter(map(len, ids), np.int64, len(ids)), np.array([i for x in ids for i in x], np.uint16))

    def _learn(self) -> None:
        """Encode the new words. Closing ASCII punctuation is a token run of its own after an ASCII letter or digit, so such a word takes the
        ids of its stem and of its punctuation, which are often known."""
        index, new = self.index, self.index.new
        first = len(index) - len(new)
        whole, joined, both = [], [], []
        for i, w in enumerate(new):  # grows while stems are looked up
            stem = w.rstrip(PUNCTUATION)
            if len(stem) < len(w) and stem[-1:].isalnum() and b"<|" not in w:
                joined.append(first + i)
                both += (index[stem], index[w[len(stem) :]])
            else:
                whole.append(i)
        for name in ("start", "length"):
            self._grow(name, len(index))
        for part in slices(len(whole), 50_000):
            self._encode([first + i for i in whole[part]], [new[i].decode() for i in whole[part]])
        if joined:
            self._put(joined, self.length[both].astype(np.int64).reshape(-1, 2).sum(axis=1), self.gather(np.array(both)))
        new.clear()

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word of the texts, and the number of words of each text. A special token's spelling counts
        only as it is written, so a text that may hold one keeps its case."""
        flat: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = (text if b"<|" in text else text.lower()).split()
            counts[i] = len(found)
            flat += found
        if len(self.index) > self.limit:
            self.clear()
        places = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        if self.index.new:
            self._learn()
        return places, counts

    def gather(self, words: np.ndarray) -> np.ndarray:
        lengths = self.length[words].astype(np.int64)
        before = np.cumsum(lengths) - lengths
        return self.pool[np.repeat(self.start[words] - before, lengths) + np.arange(int(lengths.sum()))]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        words, counts = self.words(texts)
        ends = np.concatenate([[0], np.cumsum(self.length[words].astype(np.int64))])
        at = np.concatenate([[0], np.cumsum(counts)])
        return self.gather(words), np.diff(ends[at])


def word_ids(path: str, limit: int = 1_000_000) -> WordIds:
    return worker_cache(f"word_ids_{limit}_" + "".join(c if c.isalnum() else "_" for c in path), lambda: WordIds(path, limit))

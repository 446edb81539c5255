"""Licence scan: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser evaluates the licence
expressions that follow the tags."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, column_bytes, worker_cache

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Further notice phrases (words in lower case) and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "mit license": "mit",
    "the mit licence": "mit",
    "licensed under the apache license": "apache-2",
    "apache software license version 2": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause license": "bsd-2",
    "bsd 3 clause license": "bsd-3",
    "isc license": "isc",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license": "mpl-2",
    "eclipse public license": "epl",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "cc0 1 0": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

#: Words of a tag that a licence expression follows on the same line.
TAGS = ("spdx license identifier", "license expression")

#: How freely a text under a label may be used, by the longest matching start of the label; unknown labels count as 0.4.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0, "cc0": 1.0, "public-domain": 1.0, "cc-by": 0.9,
    "cc-by-sa": 0.6, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "gpl": 0.3, "agpl": 0.2, "all-rights-reserved": 0.0,
}

#: Letters and digits of ASCII in lower case and all bytes beyond ASCII stay; everything else separates words.
WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

OPERATORS = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """A licence identifier in the form of the labels: lower case, without `-only`, `-or-later`, `+` and a closing `.0`."""
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    return re.sub(r"\.0$", "", name)


def freedom(label: str) -> float:
    starts = [s for s in FREEDOM if label.startswith(s)]
    return FREEDOM[max(starts, key=len)] if starts else 0.4


def postfix(expression: str) -> list[str] | None:
    """Operands and operators in postfix order, by the shunting-yard method; None for an expression that is not well formed."""
    output, stack, operand_next = [], [], True
    for token in re.findall(r"[()]|[A-Za-z0-9.+:-]+", expression):
        word = token.lower()
        if word in OPERATORS:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and OPERATORS[stack[-1]] >= OPERATORS[word]:
                output.append(stack.pop())
            stack.append(word)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            if not operand_next:
                return None
            output.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return output + stack[::-1]


def evaluate(expression: str) -> tuple[list[str], float] | None:
    """Labels of an expression and how freely the text may be used: `and` takes the stricter side, `or` the freer one, and an
    exception (`with`) halves the way to full freedom. None if it is not well formed."""
    items = postfix(expression)
    if not items:
        return None
    stack: list[tuple[set, float]] = []
    for item in items:
        if item in OPERATORS:
            (b, y), (a, x) = stack.pop(), stack.pop()
            stack.append((a, (x + 1) / 2) if item == "with" else (a | b, min(x, y) if item == "and" else max(x, y)))
        else:
            label = label_of(item)
            stack.append(({label}, freedom(label)))
    labels, value = stack.pop()
    return sorted(labels), value


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, phrases in (("notice", NOTICES), ("base", BASE), ("tag", {t: "" for t in TAGS})):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, phrase, label))
    found.make_automaton()
    return found


def scan_text(text: bytes) -> tuple[int, list[tuple], list[tuple]]:
    """Number of words, places (kind, label, first word, words) and evaluated expressions (text, labels, value)."""
    words = text.translate(WORDS).split()
    joined = " " + b" ".join(words).decode("latin-1") + " "
    places, expressions, tagged, at, seen = [], [], False, 0, 0
    for end, (kind, phrase, label) in worker_cache("licence_automaton", automaton).iter(joined):
        if kind == "tag":
            tagged = True
            continue
        start, size = end - len(phrase) - 1, phrase.count(" ") + 1
        stop = start + len(phrase) + 1
        at, seen = stop, seen + joined.count(" ", at, stop)
        places.append((kind, label, seen - size, size))
    if tagged:
        for m in re.finditer(r"(?i)(?:spdx[^a-z0-9\r\n]?license[^a-z0-9\r\n]?identifier|license[^a-z0-9\r\n]?expression)[\"']?[ \t]*[:=][ \t]*[\"']?([-A-Za-z0-9.+: \t()]+)",
                             text.decode("utf-8", "replace")):
            expression = re.sub(r"\s*-+$", "", m[1].strip())
            result = evaluate(expression)
            expressions.append((expression, result[0] if result else [], result[1] if result else None))
    return len(words), places, expressions


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: n_words, places (kind `base` or `notice`, label, first word, number of words) and expressions
    (text, labels, value; no labels and a null value if not well formed).

    Null and empty texts have no words and no places. Repeated rows give a row each, null ids are passed on; places that overlap are
    all given. Empty input gives no rows; other columns are ignored.
    """
    arrow_batches(docs.sparkSession)
    place = pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64()), ("size", pa.int32())])
    expression = pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan_text(t) for t in column_bytes(b, "text")]
            names = [f.name for f in place], [f.name for f in expression]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[dict(zip(names[0], x)) for x in p] for _, p, _ in found], pa.list_(place)),
                pa.array([[dict(zip(names[1], x)) for x in e] for _, _, e in found], pa.list_(expression)),
            ], names=["doc_id", "n_words", "places", "expressions"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_words long, places array<struct<kind string, label string, word long, size int>>, "
             "expressions array<struct<text string, labels array<string>, value double>>")


def freedom_column(label: Column) -> Column:
    first, *rest = sorted(FREEDOM, key=len, reverse=True)
    found = F.when(label.startswith(first), FREEDOM[first])
    for start in rest:
        found = found.when(label.startswith(start), FREEDOM[start])
    return found.otherwise(0.4)


def digest(found: DataFrame) -> DataFrame:
    """One flat row for each scanned row; score: the strictest of all notices and expressions, 0 where there is none."""
    base = F.filter("places", lambda p: p.kind == "base")
    starts = F.transform(base, lambda p: p.word)
    labels = F.array_union(F.transform("places", lambda p: p.label), F.flatten(F.transform("expressions", lambda e: e.labels)))
    values = F.concat(F.transform("places", lambda p: freedom_column(p.label)), F.filter(F.transform("expressions", lambda e: e.value), lambda v: v.isNotNull()))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda p: p.label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.coalesce(F.array_min(values), F.lit(0.0)).alias("score"), F.size("expressions").alias("n_expressions"))

"""Quality rules by host: failures of documents are counted for each host, the rates shrunk towards the corpus by an empirical beta
prior, and the verdict on the host joined back to its documents.

Everything is column expressions and joins; a text is measured in its own row, so no words are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, written

#: White space between words, and the symbols that are counted.
SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Base rules: fewest words; largest share (in hundredths) of words in repeated windows of three.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Soft rules, in hundredths: characters a word (least and most), symbols of the words, repeated lines of the lines with a word.
SHORTEST, LONGEST, MOST_SYMBOLS, MOST_LINES = 200, 1200, 10, 30
SOFT = ("failed_length", "failed_symbols", "failed_lines")
#: Shrunk rates of documents with any failure: over the first a host is suspect, over the second it is rejected.
SUSPECT, REJECTED = 0.4, 0.8
#: Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once for each row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACE[1:], " " * (len(SPACE) - 1)), " "), "")


def repeated_words(words: Column, n: Column) -> Column:
    """Words in windows of three that the text holds twice or more. Windows are sorted, by a hash first and by their words where hashes are equal, so
    equal ones are neighbours; their places in turn give the words that they cover."""
    def window(i: Column) -> Column:
        a, b, c = words[i], words[i + 1], words[i + 2]
        return F.struct(F.xxhash64(a, b, c).alias("h"), a.alias("a"), b.alias("b"), c.alias("c"), i.alias("i"))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x.h == y.h) & (x.a == y.a) & (x.b == y.b) & (x.c == y.c), F.lit(False))

    def twice(windows: Column) -> Column:
        return F.transform(F.filter(windows, lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1))), lambda x: x.i)

    def covered(state: Column, i: Column) -> Column:
        return F.struct((state.n + i + 3 - F.greatest(state.end, i)).cast("long").alias("n"), (i + 3).alias("end"))

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window))
    found = F.aggregate(F.sort_array(bound(windows, twice)), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")), covered, lambda state: state.n)
    return F.when(n >= 3, found).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of `docs` (all, if not given), n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, and whether each
    rule fails: base_failed, failed_length, failed_symbols, failed_lines, failed (any of them).

    Null and empty texts have no words and fail the base rules. A column of `docs` with the name of a measure is replaced.
    """
    keep = docs.columns if keep is None else keep
    text = F.coalesce(F.col("`" + text_col.replace("`", "``") + "`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    counts = bound(words_of(text), lambda words: bound(F.size(words), lambda n: F.struct(n.cast("long").alias("n_words"), repeated_words(words, n).alias("n_repeat_words"))))
    by_line = bound(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    chars = F.length(F.translate(text, SPACE, "")).cast("long")
    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    # One generated row is a barrier: the measures are computed once and not again in each rule.
    rows = docs.select(*quoted(keep), F.explode(F.array(F.struct(counts.alias("c"), by_line.alias("l"), chars.alias("word_chars"), symbols.alias("n_symbols")))).alias("__measures"))
    names = {"n_words": "c.n_words", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_lines": "l.n_lines", "n_dup_lines": "l.n_dup_lines", "n_repeat_words": "c.n_repeat_words"}
    made = ("base_failed", *SOFT, "failed")
    rows = rows.select(*quoted([n for n in keep if n not in names and n not in made]), *[F.col(f"__measures.{at}").alias(n) for n, at in names.items()])
    rows = rows.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        "failed_length": (100 * F.col("word_chars") < SHORTEST * F.col("n_words")) | (100 * F.col("word_chars") > LONGEST * F.col("n_words")),
        "failed_symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words"),
        "failed_lines": 100 * F.col("n_dup_lines") > MOST_LINES * F.col("n_lines"),
    })
    return rows.withColumn("failed", F.col("base_failed") | F.col(SOFT[0]) | F.col(SOFT[1]) | F.col(SOFT[2]))


def host_rates(rows: DataFrame, host_col: str) -> DataFrame:
    """(host, n, n_failed, rate): the rate of failed documents of each host, shrunk by a beta prior whose mean is the corpus rate and whose weight comes
    from how much hosts differ beyond chance (moments). Rows without a host belong to none."""
    host = F.col("`" + host_col.replace("`", "``") + "`")
    hosts = written(rows.where(host.isNotNull()).groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.count_if("failed").alias("n_failed")))
    n, f = F.col("n").cast("double"), F.col("n_failed").cast("double")
    total, failed, many, squares, by_host = hosts.agg(F.sum(n), F.sum(f), F.count("*"), F.sum(n * n), F.sum(f * f / n)).first()
    mean, weight = prior(total or 0.0, failed or 0.0, many, squares or 0.0, by_host or 0.0)
    return hosts.withColumn("rate", (f + weight * mean) / (n + weight))


def prior(total: float, failed: float, many: int, squares: float, by_host: float) -> tuple[float, float]:
    """Mean and weight of the prior, from the documents, the failures, the hosts, the sum of squared documents and of failures² / documents by host."""
    if not total:
        return 0.0, LEAST_WEIGHT
    mean = failed / total
    chance = mean * (1 - mean)
    spread = total - squares / total
    between = (by_host - failed * mean - (many - 1) * chance) / spread if spread > 0 else 0.0
    if between <= 0 or chance <= 0:
        return mean, MOST_WEIGHT
    return mean, min(max(chance / between - 1, LEAST_WEIGHT), MOST_WEIGHT)


def judged(docs: DataFrame, host_col: str = "source", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`measured`, with host_rate, host_verdict (`good`, `suspect`, `rejected`) and kept.

    A document goes if the base rules fail, its host is rejected, it fails a soft rule on a suspect host, or it fails two soft rules anywhere. Rows without
    a host count in no rate and are judged as on a good one (null rate). Repeated rows count and return once each; an empty table gives no rows.
    """
    keep = docs.columns if keep is None else keep
    rows = written(measured(docs, text_col, [*keep, host_col] if host_col not in keep else keep))
    named = "__host_of_row"
    rates = host_rates(rows, host_col).select(F.col("host").alias(named), F.col("rate").alias("host_rate"))
    rows = rows.drop("host_rate", "host_verdict", "kept")
    found = rows.join(rates, rows[f"`{host_col}`"] == rates[named], "left").drop(named)
    verdict = F.when(F.col("host_rate") > REJECTED, "rejected").when(F.col("host_rate") > SUSPECT, "suspect").otherwise("good")
    soft = sum((F.col(name).cast("int") for name in SOFT), F.lit(0))
    found = found.withColumn("host_verdict", verdict)
    most = F.when(F.col("host_verdict") == "rejected", -1).when(F.col("host_verdict") == "suspect", 0).otherwise(1)
    found = found.withColumn("kept", ~F.col("base_failed") & (soft <= most))
    return found if host_col in keep else found.drop(host_col)


def keep_good(docs: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `judged` keeps, with their columns."""
    return judged(docs, host_col, text_col).where("kept").select(*quoted(docs.columns))


SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN string_split_regex(text, '[ \t\n\x0B\f\r]+') IF x <> ''] AS words,
      [x FOR x IN string_split(text, chr(10)) IF trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''] AS lines FROM t),
windows AS (SELECT row, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row),
m AS (
    SELECT w.row, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) FOR x IN words]), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN covered ON w.row = covered.row),
r AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
        CAST(100 * word_chars < {SHORTEST} * n_words OR 100 * word_chars > {LONGEST} * n_words AS INTEGER)
        + CAST(100 * n_symbols > {MOST_SYMBOLS} * n_words AS INTEGER) + CAST(100 * n_dup_lines > {MOST_LINES} * n_lines AS INTEGER) AS soft FROM m),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed OR soft > 0 AS INTEGER)) AS DOUBLE) AS f FROM r WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT sum(f) / sum(n) AS mean, sum(f) AS failed, count(*) AS many, sum(n) - sum(n * n) / sum(n) AS spread, sum(f * f / n) AS by_host FROM h),
b AS (SELECT mean, CASE WHEN spread > 0 THEN (by_host - failed * mean - (many - 1) * mean * (1 - mean)) / spread ELSE 0 END AS between_hosts FROM s),
p AS (SELECT mean, CASE WHEN between_hosts <= 0 OR mean * (1 - mean) <= 0 THEN {MOST_WEIGHT}
      ELSE least(greatest(mean * (1 - mean) / between_hosts - 1, {LEAST_WEIGHT}), {MOST_WEIGHT}) END AS weight FROM b),
v AS (SELECT source, (f + weight * mean) / (n + weight) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND soft <= CASE WHEN rate > {REJECTED} THEN -1 WHEN rate > {SUSPECT} THEN 0 ELSE 1 END AS kept
FROM r LEFT JOIN v ON r.source = v.source
"""

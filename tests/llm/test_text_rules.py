"""Periodic runs, host rules and token spans: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import host_rules, periods, token_spans
from sensorloom.llm.common import table
from sensorloom.llm.queries import op11_periodic_runs, op12_host_rules, op13_token_spans, vocabulary

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    border = [0] * len(w)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = border[k - 1]
        k += w[i] == w[k]
        border[i] = k
    return len(w) - border[-1]


def plain_runs(w):
    found = set()
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(12, 2 * p) and smallest_period(w[i : j + p]) == p:
                found.add((i, j - i + p, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda x: (x[0], x[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def odd_words(rng):
    kind, n = rng.randrange(6), rng.randrange(0, 110)
    if kind < 2:
        return rng.choices("abc"[: 2 + kind], k=n)
    if kind == 2:
        unit = rng.choices("abcd", k=rng.randrange(1, 40))
        return rng.choices("abcd", k=rng.randrange(8)) + unit * rng.randrange(1, 5) + unit[: rng.randrange(len(unit))] + rng.choices("abcd", k=rng.randrange(8))
    if kind == 3:
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 4:
        return (["a", "b"] * rng.randrange(1, 9) + ["a"] * rng.randrange(2)) * rng.randrange(1, 6)
    x = rng.choices("ab", k=rng.randrange(1, 6))
    one, two = ((x * 30)[rng.randrange(len(x)) :][: rng.randrange(5, 60)] for _ in range(2))
    return one + two + one[: rng.randrange(len(one))] + two


def test_runs_are_those_of_brute_force():
    rng = random.Random(4)
    for _ in range(25):
        texts = [[c.encode() for c in odd_words(rng)] for _ in range(60)]
        text, start, length, period, kept = periods.runs_of_texts(texts)
        done = 0
        for i, words in enumerate(texts):
            own = text == i
            assert list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist())) == plain_runs(words)
            left = [w.decode() for w, k in zip(words, kept[done : done + len(words)]) if k]
            assert " ".join(left) == collapsed([w.decode() for w in words], plain_runs(words))
            done += len(words)


def test_adjacent_stretches_of_equal_period():
    """A run whose two halves are stretches of a smaller period that touch: its period is no difference of their ends."""
    words = list(b"babababaabababab")
    assert (1, 14, 7) in plain_runs(words)
    text, start, length, period, _ = periods.runs_of_texts([[bytes([w]) for w in words]])
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words)


def test_runs_do_not_depend_on_parts(monkeypatch):
    rng = random.Random(9)
    words = [[c.encode() for c in odd_words(rng)] for _ in range(40)]
    sizes = np.array([len(w) for w in words])
    whole = periods.runs_of_texts(words)
    monkeypatch.setattr(periods, "PART", 30)
    cut = list(periods.parts(sizes))
    assert [i for p in cut for i in range(p.start, p.stop)] == list(range(40)) and len(cut) > 5
    assert sum(len(periods.runs_of_texts(words[p])[0]) for p in cut) == len(whole[0])


def planted_words(doc_id, text):
    words = SPACE.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def run_row(doc_id, text):
    words = planted_words(doc_id, text)
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best[:3] if best else (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(collapsed(words, found)))


def odd_rows(spark):
    rows = [(1, None, "a", None), (2, "", "b", "x"), (3, " \t\n", "c", "x"), (4, "one two " * 30, "d", "y"), (4, "one two " * 30, "d", "y"), (None, "go " * 20, "e", "y"), (None, None, "f", None),
            (5, "long " * 3000, "g", "x"), (6, "é ü x 漢字 😀 ", "h", "x"), (17, "a b c " * 9 + "d\x0ba\rb", "i", "y"), (8, "the <s> <|endoftext|> it's\n\n  x \n y", "j", "y"), (9, "▁a b", "k", "x"),
            (10, "nul\0 x", "l", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, source string")


def test_runs_of_documents_and_odd_rows(spark):
    docs = table(spark, SF, "documents")
    short = {r.doc_id: r.text for r in docs.where("length(text) < 3000").collect()}
    got = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, SF).collect()}
    assert len(got) == docs.count() and len(short) > 100
    for i, text in short.items():
        assert got[i] == run_row(i, text)
    assert any(got[i][1] for i in short if zlib.crc32(str(i).encode()) % 10 == 0)
    odd = odd_rows(spark)
    rows = [(r.doc_id, r.text) for r in odd.where("doc_id is null or doc_id != 5").collect()]
    found = periods.digest(periods.periodic_runs(periods.planted(odd)))
    assert Counter(map(tuple, found.where("doc_id is null or doc_id != 5").collect())) == Counter(run_row(*r) for r in rows)
    long = found.where("doc_id = 5").first()
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 3000, 1)
    assert periods.periodic_runs(odd.limit(0)).count() == 0


def rule_row(text):
    text = text or ""
    words = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_measures_of_documents_and_odd_rows(spark):
    odd = odd_rows(spark).union(spark.createDataFrame([(30, "a b c\r\nx y z\na b c\nx y z\n\n \n \n#a%", "m", "y"), (31, "a a a a", "n", "y")], odd_rows(spark).schema))
    docs = table(spark, SF, "documents").select("doc_id", "text", F.lit("x").alias("a.b"), "source").union(odd)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = host_rules.measured(docs)
    assert found.columns[:4] == docs.columns
    assert Counter(tuple(r[n] for n in names) for r in found.collect()) == Counter(rule_row(r.text) for r in docs.collect())
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in found.collect())


def good_text(rng):
    return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(80))


def test_hosts_are_judged_by_shrunk_rates(spark):
    rng = random.Random(2)
    good, soft, bad = lambda: good_text(rng), lambda: good_text(rng) + " #" * 30, lambda: "spam " * 100
    rows = [("fine", good) for _ in range(300)] + [("fine", soft) for _ in range(3)] + [("worst", bad) for _ in range(95)] + [("worst", good) for _ in range(5)]
    rows += [("half", bad) for _ in range(60)] + [("half", good) for _ in range(40)] + [("half", soft) for _ in range(2)] + [("once", bad), (None, soft), (None, bad)] + [("lone", soft)]
    docs = spark.createDataFrame([(i, make(), host, "x") for i, (host, make) in enumerate(rows)], "doc_id long, text string, source string, kept string")
    found = [r.asDict() for r in host_rules.judged(docs, keep=["doc_id", "source"]).collect()]
    verdict = {r["source"]: r["host_verdict"] for r in found}
    assert verdict == {"fine": "good", "worst": "rejected", "half": "suspect", None: "good", "once": verdict["once"], "lone": verdict["lone"]}
    kept = Counter(r["source"] for r in found if r["kept"])
    assert kept["fine"] == 303 and kept["worst"] == 0 and kept["half"] == 40 and kept[None] == 1
    rate = {r["source"]: r["host_rate"] for r in found}
    failed = sum(make is not good for h, make in rows if h)
    n = {h: sum(x == h for x, _ in rows) for h in rate if h}
    f = {h: sum(x == h and make is not good for x, make in rows) for h in n}
    mean, weight = host_rules.prior(sum(n.values()), failed, len(n), sum(x * x for x in n.values()), sum(f[h] ** 2 / n[h] for h in n))
    assert all(abs(rate[h] - (f[h] + weight * mean) / (n[h] + weight)) < 1e-9 for h in n) and rate[None] is None
    assert mean < rate["once"] < 1 and f["once"] == n["once"]  # one failure says little
    assert host_rules.keep_good(docs).columns == docs.columns and host_rules.keep_good(docs).count() == sum(kept.values())
    assert host_rules.judged(docs.limit(0)).count() == 0


def test_prior_of_equal_and_empty_hosts():
    assert host_rules.prior(0, 0, 0, 0, 0) == (0.0, host_rules.LEAST_WEIGHT)
    assert host_rules.prior(200, 20, 2, 20_000, 2.0) == (0.1, host_rules.MOST_WEIGHT)
    assert host_rules.prior(100, 100, 1, 10_000, 100) == (1.0, host_rules.MOST_WEIGHT)


def test_host_rules_are_native(spark):
    plan = op12_host_rules(spark, SF)._jdf.queryExecution().toString() + host_rules.measured(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def tool():
    return token_spans.Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def by_tokens(tool, text):
    """Ids, links and groups of a whole text, from the bytes of its tokens alone."""
    a, b = tool.a.encode(" " + text, add_special_tokens=False).ids, tool.b.encode(text)
    raw = (" " + text).encode()
    of_a, of_b = [tool.of_a.tokens[i] for i in a], [tool.of_b.tokens[i] for i in b]
    if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
        return None
    ends = []
    for words in (of_a, of_b):
        at = np.cumsum([len(w) for w in words]).tolist()
        ends.append(dict(zip(at, range(len(at)))))
    groups, links, x, y = [], [], 0, 0
    for cut in sorted(ends[0].keys() & ends[1].keys()):
        p, q = ends[0][cut] + 1, ends[1][cut] + 1
        groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
        links.append((a[p - 1], b[q - 1]))
        x, y = p, q
    return len(a), len(b), links, ";".join(groups)


def span_rows(tool, rows):
    found = [(i, by_tokens(tool, t) if t else None) for i, t in rows]
    count = Counter(x for _, r in found if r for x in r[2])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    return Counter((i, 0, 0, 0, 0, 0, 0, "") if r is None else (
        i, r[0], r[1], len(r[2]), len(r[2]), sum(count[x] == most[x[1]] for x in r[2]), sum(count[x] for x in r[2]), hashlib.sha256(r[3].encode()).hexdigest()) for i, r in found)


def test_alignment_of_documents_and_odd_rows(spark, tool):
    docs = table(spark, SF, "documents")
    assert Counter(map(tuple, op13_token_spans(spark, SF).collect())) == span_rows(tool, [(r.doc_id, r.text) for r in docs.collect()])
    odd = odd_rows(spark)
    found = token_spans.digest(token_spans.align(odd, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")))
    expected = span_rows(tool, [(r.doc_id, r.text) for r in odd.collect()])
    assert Counter(map(tuple, found.collect())) == expected
    assert (9, 0, 0, 0, 0, 0, 0, "") in expected and any(r[0] == 10 and r[1] for r in expected)
    assert token_spans.align(odd.limit(0), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).count() == 0
    broken = spark.createDataFrame([(1, bytearray(b"a \xff b"))], "doc_id long, text binary")
    assert token_spans.align(broken, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).first().n_a == 0


def test_segments_are_cut_and_joined_without_a_trace(tool):
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "漢", "😀", "﷽", "'s", "1", ".", " ", "▁", "\0", "-", "x"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 25))) for _ in range(400)]
    places, counts = tool.places([t.encode() for t in texts])
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends):
        own, expected = places[end - n : end], by_tokens(tool, text)
        assert (expected is not None) == bool(tool.good[own].all())
        if expected:
            assert ";".join(tool.groups[i] for i in own) == expected[3]
            assert (tool.n_a[own].sum(), tool.n_b[own].sum(), tool.n_links[own].sum()) == (expected[0], expected[1], len(expected[2]))


def test_coarse_cuts_are_refined_by_decoded_bytes(tool):
    """Ends of spans, refined, are the sums of decoded bytes; inside one character they are not among its bounds."""
    text = " 漢😀 é ﷽x"
    a, a_end, _, b, b_end, _, good = tool.ends([text])
    assert good.all()
    for ids, end, words in ((a, a_end, tool.of_a), (b, b_end, tool.of_b)):
        assert end.tolist() == np.cumsum(words.length[ids]).tolist()
    begin, stop = np.array([0, 1, 1, 1]), np.array([1, 1, 1, 2])  # an ASCII letter, then a character of three bytes in three tokens
    assert token_spans.refined(begin, stop, np.array([False, False, False, True]), np.array([0, 1, 4]), np.array([1, 1, 1, 1])).tolist() == [1, 2, 3, 4]


def test_links_are_possible_pairs_and_their_number_is_bounded(tool):
    assert len(tool.pairs) <= 2 * (sum(tool.of_a.length) + sum(tool.of_b.length))
    for key in random.Random(1).sample(tool.pairs.tolist(), 500):
        a, b = tool.of_a.tokens[key // token_spans.PIECES], tool.of_b.tokens[key % token_spans.PIECES]
        assert a.endswith(b) or b.endswith(a)


def test_segments_without_groups_are_kept_twice_as_long():
    """The first pass keeps no groups and so twice as many segments before its cache is emptied; places and links stay those of a new cache."""
    tool = token_spans.Aligner(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), segments=3)
    texts = [b"one two three four five", b"six seven one", b"eight"]
    for with_groups, kept in ((False, True), (True, False)):
        tool.clear(with_groups)
        first = tool.index
        tool.places(texts[:1], with_groups)
        places, counts = tool.places(texts[1:2], with_groups)
        assert (tool.index is first) == kept and counts.tolist() == [3]
        assert (tool.n_links[places] > 0).all()
    tool.clear(False)
    tool.places(texts[:1], False), tool.places(texts[1:2], False)
    full = tool.index
    tool.places(texts[2:], False)
    assert tool.index is not full

"""Near-duplicates, packing, licences, pieces, search, pages, media, pipeline: against brute force and round trips."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sensorloom.llm import copies, licenses, media, packing, pages, pieces, simhash, topk
from sensorloom.llm.common import table
from sensorloom.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def odd_documents(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "one two", "c"), (4, "one two", "d"), (4, "one two", "d"), (None, "one two three four", "e"), (None, None, "f"),
            (5, "long " * 40_000, "g"), (6, "Ünï ßtraße ünï. <|endoftext|> 'S it's", "h"), (7, "one  TWO", "i")]
    return spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")


def by_bits(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, most):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= most:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_near_duplicates_of_documents_and_odd_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", F.lit("x").alias("a.b")).union(odd_documents(spark).withColumn("doc_id", F.col("doc_id") + 100_000))
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    fps = {t: by_bits(t) for _, t in rows}
    root = roots(sorted(set(fps.values())), 3)
    least: dict = {}
    for i, t in rows:
        if i is not None:
            least[root[fps[t]]] = min(i, least.get(root[fps[t]], i))
    expected = Counter((i, format(fps[t], "016x"), least.get(root[fps[t]])) for i, t in rows)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()) == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.get(k) for k in set(root.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [2, 7, 65536])
def test_links_keep_every_component_at_any_bucket_limit(spark, limit):
    rng = random.Random(limit)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    fps = set(base)
    for f in base:
        chain = f
        for _ in range(15):
            for b in rng.sample(range(64), rng.choice([1, 3, 4])):
                chain ^= 1 << b
            fps.add(chain)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    edges = simhash.similar_links(df, limit=limit)
    for a, b in edges.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    found = {r.node % (1 << 64): r.root for r in simhash.components(edges).collect()}
    expected = roots(fps, 3)
    groups = {}
    for f in fps:
        groups.setdefault(expected[f], set()).add(f)
    for group in groups.values():
        assert len({found.get(f) for f in group}) == 1 and (len(group) == 1) == (next(iter(group)) not in found)


def test_large_bucket_is_split_without_losing_links():
    rng = np.random.default_rng(3)
    mask = simhash.block_masks(3, 6)[0]
    free = [b for b in range(64) if not mask >> b & 1]
    fps = np.unique([sum(1 << free[i] for i in rng.choice(len(free), rng.integers(0, 4), replace=False)) for _ in range(300)]).astype(np.uint64)
    direct, split = simhash.linked(fps, 3), simhash.bucket_edges(fps, mask, 3, direct=5)

    def parts(edges):
        parent = list(range(len(fps)))
        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in zip(*edges):
            parent[find(int(a))] = find(int(b))
        return [min(j for j in range(len(fps)) if find(j) == find(i)) for i in range(len(fps))]

    assert parts(direct) == parts(split)


def test_distinct_words_find_edited_copies(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    texts = [[rng.choice(words) for _ in range(150)] for _ in range(40)]
    edited = [[*t[:60], "edited", *t[61:]] for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts + edited)], "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(docs, **corpus_pipeline.NEAR).collect()}
    assert set(range(40)) <= kept and len(kept) <= 42
    options = {k: v for k, v in corpus_pipeline.NEAR.items() if k != "limit"}
    fps = {i: simhash.fingerprint(" ".join(t).encode(), 1, True) for i, t in enumerate(texts + edited)}
    root = roots(sorted(set(fps.values())), 6)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, **options).collect()}
    assert found == {i: min(j for j in fps if root[fps[j]] == root[f]) for i, f in fps.items()}


def by_shingles(texts: list[bytes], n: int = 5, share: float = 0.8) -> list[int]:
    """Least number of each text's group, by all pairs."""
    words = [t.lower().split() for t in texts]
    sets = [frozenset(b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset() for w in words]
    group = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if min(len(sets[i]), len(sets[j])) >= share * max(len(sets[i]), len(sets[j])) and len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
            low, high = sorted((group[i], group[j]))
            group = [low if g == high else g for g in group]
    return group


def test_pipeline_drops_only_confirmed_copies(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    texts = [[rng.choice(words) for _ in range(rng.choice((60, 150, 400)))] for _ in range(30)]
    mixed = [rng.sample(t, len(t)) for t in texts[:10]]
    edited = [[*t[:20], "edited", *t[21:]] for t in texts[10:]]
    far = [[w if i % 12 else "changed" for i, w in enumerate(t)] for t in texts[20:]]
    chain = [texts[0]]
    for i in range(12):
        chain.append([*chain[-1][: 5 * i], f"step{i}", *chain[-1][5 * i + 1 :]])
    every = [" ".join(t) for t in texts + mixed + edited + far + chain[1:]] + ["", " ", "A b", "a  B"]
    docs = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == set(by_shingles([t.encode() for t in every]))
    assert set(range(40)) <= kept


def test_similar_texts_meet_though_their_edge_was_refused(spark):
    texts = {1: range(0, 50), 2: range(100, 150), 3: range(100, 149), 4: range(0, 49), 5: range(300, 350)}
    sets = spark.createDataFrame([(k, list(v)) for k, v in texts.items()], "node long, shingles array<bigint>")
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (1, 5)], "a long, b long")
    found = copies.confirmed(edges, sets, 80)
    assert found.count() == 0
    more = copies.unjoined(edges, found, sets, 80)
    assert {tuple(r) for r in copies.confirmed(more, sets, 80).collect()} == {(1, 4), (2, 3)}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (202, 202)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def levels_by_hand(counts: dict, size: int, window: int) -> set:
    """All levels that leave the least sum of squares over partly filled levels."""
    def after(level):
        n = dict(counts)
        if level:
            n[level] -= 1
        if level + size < window:
            n[level + size] = n.get(level + size, 0) + 1
        return sum(v * v for v in n.values())

    options = [0] + [h for h, n in counts.items() if n and h + size <= window]
    least = min(after(h) for h in options)
    return {h for h in options if after(h) == least}


def test_level_choice_is_the_least_sum_of_squares():
    rng, levels, counts = random.Random(1), packing.LevelArray(16), {}
    for _ in range(400):
        size = rng.choice([1, 2, 3, 5, 7, 11, 15])
        level = levels.level_for(size)
        assert level in levels_by_hand(counts, size, 16)
        levels.place((size, None, 0, None))
        if level:
            counts[level] -= 1
        if level + size < 16:
            counts[level + size] = counts.get(level + size, 0) + 1
        assert {h: n for h, n in counts.items() if n} == {h: int(n) for h, n in enumerate(levels.count) if n}


@pytest.mark.parametrize("most_open", [3, 4096])
def test_stream_has_each_id_once_and_little_padding(most_open):
    rng = np.random.default_rng(most_open)
    docs = [(i, np.arange(n, dtype="<u4")) for i, n in enumerate(rng.integers(1, 100, 300))]
    windows = list(packing.pack_stream(iter(docs), 32, most_open))
    assert all(sum(p[0] for p in w) == 32 for w in windows[:-5]) and all(sum(p[0] for p in w) in (1, 2, 4, 8, 16, 32) for w in windows)
    found = {}
    for length, key, start, ids in (p for w in windows for p in w):
        assert length == len(ids) and (ids == np.arange(start, start + length)).all()
        found.setdefault(key, []).append((start, start + length))
    for i, ids in docs:
        spans = sorted(found[i])
        assert spans[0][0] == 0 and spans[-1][1] == len(ids) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_packed_documents(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    docs = odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(1)
    rows = packing.pack(docs, vocabulary("word_bpe_49k.json"), with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for d in docs.collect():
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [1]
        mine = sorted(by_doc[d.doc_id], key=lambda r: r.start)
        assert [i for r in mine for i in r.ids] == ids and {r.doc_tokens for r in mine} == {len(ids)}
    for part in by_sequence.values():
        part.sort(key=lambda r: r.offset)
        assert [r.offset for r in part] == [sum(x.length for x in part[:i]) for i in range(len(part))] and sum(r.length for r in part) <= 2048
    assert packing.pack(odd_documents(spark), vocabulary("word_bpe_49k.json")).where("doc_id is null and start = 0").count() == 2
    assert packing.pack(docs.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


LICENCE_TEXTS = ["", "under the MIT license, UNDER THE MIT-LICENSE under the mit license", "x Apache License, Version 2.0", "é under the mit licenseé cc by nc cc by-nc 4.0 CC BY NC SA",
                 "cc by nc" * 3, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-3.0-only WITH Classpath-exception-2.0\nAll rights reserved.",
                 "# SPDX-License-Identifier: MIT AND\n", "w " * 90_000 + "under the mit license", "the apache license version 2under"]


def test_licence_scan(spark):
    rows = [(i, t) for i, t in enumerate(LICENCE_TEXTS)] + [(90, None), (1, LICENCE_TEXTS[1]), (None, LICENCE_TEXTS[3])]
    found = licenses.digest(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("places", F.lit(0)))).collect()
    assert len(found) == len(rows)
    for (i, t), r in zip(sorted(rows, key=str), sorted(found, key=lambda r: str((r.doc_id, "")))):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        hits = [(k, label) for p, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        assert (r.doc_id, r.n_words, r.n_base) == (i, len(words), len(hits))
        assert (r.first_word, r.last_word) == ((min(hits)[0], max(hits)[0]) if hits else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in hits})) and {x for _, x in hits} <= set(r.labels.split(","))
    by_id = {r.doc_id: r for r in found}
    assert by_id[5].labels == "all-rights-reserved,apache-2,gpl-3,mit" and by_id[5].score == 0.0 and by_id[6].labels == "" and by_id[7].score == 1.0
    assert licenses.digest(licenses.scan(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


@pytest.mark.parametrize(("text", "labels", "value"), [
    ("MIT", ["mit"], 1.0), ("MIT OR GPL-3.0-only", ["gpl-3", "mit"], 1.0), ("MIT AND GPL-3.0-or-later", ["gpl-3", "mit"], 0.3),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2"], 0.65), ("MIT OR GPL-3.0-only AND CC-BY-NC-4.0", ["cc-by-nc-4", "gpl-3", "mit"], 1.0),
    ("(MIT OR GPL-3.0-only) AND CC-BY-NC-4.0", ["cc-by-nc-4", "gpl-3", "mit"], 0.1)])
def test_licence_expressions(text, labels, value):
    assert licenses.evaluate(text) == (labels, pytest.approx(value))


@pytest.mark.parametrize("text", ["", "MIT MIT", "AND", "(MIT", "MIT)", "MIT OR", "()", "MIT (GPL-2.0)"])
def test_malformed_licence_expressions(text):
    assert licenses.evaluate(text) is None


@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice({"▁": (1, -1.0), "▁a": (2, -1.5), "a": (3, -1.0), "b": (4, -2.0), "ab": (5, -2.0), "aba": (6, -2.5), "▁ab": (7, -3.0), "▁▁": (8, -1.0)},
                          {b: 100 + b for b in range(256)})


def all_segmentations(lattice, word):
    if not word:
        return [(0.0, ())]
    out = []
    for end in range(1, len(word) + 1):
        hit = lattice.pieces.get(word[:end])
        if hit is None and end == 1:
            hit = (lattice.penalty, tuple(lattice.byte_ids[b] for b in word[0].encode()))
        if hit:
            out += [(hit[0] + s, hit[1] + ids) for s, ids in all_segmentations(lattice, word[end:])]
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["a", "ababa", "ab aba  b", "é日", " a ", "\n", "aaaa", "b▁a"])
def test_n_best_pieces_equal_enumeration(lattice, text):
    whole = all_segmentations(lattice, "▁" + text.replace(" ", "▁"))
    words = pieces.Words(lattice, 4, limit=3)
    at = words.places(lattice.words(text))
    best = words.scores[at, 0].sum()
    assert [pytest.approx(best - loss) for loss, _ in pieces.merged(words.scores[at], 4)] == [s for s, _ in whole[:4]]
    ids, _ = words.best_ids(at)
    assert (best, tuple(ids.tolist())) in [(pytest.approx(s), i) for s, i in whole] and ("▁" in text or lattice.decode(ids) == text)


def test_words_are_cut_where_no_piece_crosses(lattice):
    """A text of many different words of the same parts searches each part once."""
    words = pieces.Words(lattice, 4)
    text = " ".join(f"ab{i}\naba,é{i}" for i in range(300))
    at = words.places(lattice.words(text))
    assert len(words.index) < 20 and "".join(lattice.words(text)) == "▁" + text.replace(" ", "▁")
    ids, _ = words.best_ids(at)
    assert words.whole[at].all() and lattice.decode(ids) == text
    crossed = pieces.Lattice({"▁": (1, -1.0), "a": (2, -1.0), "1": (3, -1.0), "a1": (4, -1.0), "b": (5, -1.0), "1▁": (6, -1.5)})
    assert crossed.words("ba1 a") == ["▁ba1▁a"]


def test_merging_equals_enumeration():
    rng = np.random.default_rng(0)
    for _ in range(100):
        scores = -np.sort(rng.integers(0, 5, (rng.integers(1, 6), 3)), axis=1).astype(float)
        losses = sorted(sum(scores[i, 0] - scores[i, c] for i, c in enumerate(choice)) for choice in product(range(3), repeat=len(scores)))
        assert [loss for loss, _ in pieces.merged(scores, 4)] == losses[:4]


def test_segmented_documents_decode_to_themselves(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(40).union(odd_documents(spark).select(F.col("doc_id") + 100_000, "text"))
    found = pieces.segment(docs.withColumn("score", F.lit("x")), vocabulary("piece_bpe_32k.model"), 3, with_ids=True)
    rows = found.collect()
    assert all(r.round_trip and r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert Counter((r.doc_id, r.text) for r in pieces.decoded(found.where("rank = 1"), vocabulary("piece_bpe_32k.model")).collect()) == texts
    scores = {}
    for r in sorted(rows, key=lambda r: r.rank):
        if r.doc_id is not None and r.doc_id != 100_004:
            scores.setdefault(r.doc_id, []).append((r.score, tuple(r.ids)))
    assert all(a[0] >= b[0] and len(set(x)) == len(x) for x in scores.values() for a, b in zip(x, x[1:]))
    assert pieces.segment(docs.limit(0), vocabulary("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize(("block", "queries", "size", "high"), [(8192, 1024, 300, 300), (16, 4, 120, 3), (7, 3, 61, 1 << 28)])
def test_search_equals_brute_force(spark, block, queries, size, high):
    rng = np.random.default_rng(size)
    vectors = rng.integers(-high, high, (size, 5))
    vectors[size // 3 : size // 2] = vectors[0]
    ids = np.arange(size)
    ids[-3:] = 10
    rows = [(int(i), [int(x) for x in v], "x") for i, v in zip(ids, vectors)] + [(5000, None, "x"), (5010, [1, None], "x"), (None, [1, 2, 3, 4, 5], "x")]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>, score string").repartition(3)
    got = topk.best_scores(df, 5, "vec_id", "v", F.col("vec_id") % 10 == 0, block, queries).collect()
    expected = Counter()
    for q in np.flatnonzero(ids % 10 == 0):
        best = sorted((-int(vectors[j] @ vectors[q]), int(ids[j])) for j in range(size) if j != q)[:5]
        expected.update((int(ids[q]), r, i, -s) for r, (s, i) in enumerate(best, 1))
    assert Counter(map(tuple, got)) == expected


def test_search_of_few_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, [0.5, -0.001]), (50, [1.0, 2.0]), (51, [nan, 1.0]), (52, [inf, 1.0]), (53, None), (54, [0.0])], "vec_id long, e array<float>")
    rows = topk.best_scores(df.select("vec_id", topk.scaled("e").alias("v")), 5, "vec_id", "v", F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, rows)) == [(0, 1, 50, 128 * 256 - 512), (0, 2, 54, 0), (50, 1, 0, 128 * 256 - 512), (50, 2, 54, 0)]
    none = df.where("vec_id = 54").select("vec_id", topk.scaled("e").alias("v"))
    assert topk.best_scores(none, 5, "vec_id", "v", F.col("vec_id") % 50 == 0).count() == 0
    assert topk.best_scores(none.limit(0), 5, "vec_id", "v", F.lit(True)).count() == 0


@pytest.mark.parametrize(("page", "texts"), [
    ("", []), ("plain &amp; simple", ["plain & simple"]), ("<p>one<p>two &lt;b&gt; &nbsp; x", ["one", "two <b> x"]),
    ("<body><header><h1>Site</h1></header><div class='layout has-sidebar'><main><article class=post><header><h1>T &amp; t</h1></header><p>a <b>b</b><br>c<ul><li>x<li>y <a href=q>z</a>"
     "</ul>tail<div class='share-bar'>no</div></article></main><aside>no</aside></div><section id=comments><article class=comment>no</article></section>", ["T & t", "a b c", "x", "y z", "tail"]),
    ("<nav>no</nav><div class='cookie-notice'>no</div><table><tr><td>1<td>2<tr><td>3</table><script>if(a<b){'</p>'}</script>end<form>no</form>", ["1", "2", "3", "end"]),
    ("<p title=don't>it's</p><a b='c>d'>q</a><!-- <p>no</p> --><style>p{}</style>", ["it's", "q"]), ("<article><p>a</article><article>b", ["a", "b"]),
    ("<div hidden>no</div><div aria-hidden=true>no</div><p style='display: none'>no</p><p>x &#233;&eacute;\n\t y", ["x éé y"])])
def test_page_blocks(page, texts):
    assert [t for t, _ in pages.blocks(page)] == texts


def test_site_templates_are_deleted_by_host(spark):
    rows = [(i, f"https://a.example/{i}", f"<p>Own text {i}.</p><p>Subscribe  to us</p><div><span>Best of</span> {i % 3}</div>") for i in range(12)]
    rows += [(100 + i, f"http://b.example/{i}", "<p>Subscribe to us</p>") for i in range(3)]
    rows += [(200, None, None), (200, None, None), (None, "", "<p>x</p>"), (201, "http://a.example:80/x", "<p>Subscribe to us</p>" + "<p>long</p>" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit("clash"))
    for most in (500_000, -1):
        found = Counter((r.page_id, r.url, r.text, r.n_chars) for r in pages.main_text(df, broadcast_hashes=most).collect())
        assert {t for i, _, t, _ in found if i is not None and i < 12} == {f"Own text {i}.\nBest of {i % 3}" for i in range(12)}
        assert {t for i, _, t, _ in found if i is not None and 100 <= i < 110} == {"Subscribe to us"}
        assert found[(200, None, "", 0)] == 2 and found[(None, "", "x", 1)] == 1 and found[(201, "http://a.example:80/x", "\n".join(["long"] * 5000), 24999)] == 1
    assert pages.main_text(df.limit(0)).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    article = "".join(f"<p>Paragraph {k} of the article.</p>" for k in range(4))
    rows = [(i, f"https://a.example/{i}", article + "<p>Seen everywhere</p>") for i in range(40)]
    rows += [(100 + i, f"https://a.example/o{i}", f"<p>Own {i}</p><p>Seen everywhere</p>") for i in range(20)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[i] for i in range(40)} == {"\n".join(f"Paragraph {k} of the article." for k in range(4))}
    assert all(got[100 + i] == f"Own {i}" for i in range(20))


def test_templates_of_a_small_share_and_of_small_hosts(spark):
    def page(i, *more):
        return f"<p>Own text {i}.</p><p>More of {i}.</p>" + "".join(f"<div><p>{m}</p></div>" for m in more)

    rows = [(i, f"https://big.example/{i}", page(i, *(f"T{s}" for s in (5, 10, 20, 49) if i * s % 100 < s))) for i in range(200)]
    rows += [(1000 + i, f"https://small.example/{i}", page(i, *(["Seen often"] if i < 4 else []), *(["Quoted"] if i > 4 else []))) for i in range(7)]
    rows += [(2000 + i, f"https://two.example/{i}", page(i, "Both")) for i in range(2)]
    assert sum("T5<" in h for _, _, h in rows) == 10 and sum("T49<" in h for _, _, h in rows) == 98
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, _ in rows:
        own = [f"Own text {i % 1000}.", f"More of {i % 1000}."]
        assert got[i].split("\n") == own + (["Quoted"] if i in (1005, 1006) else ["Both"] if i >= 2000 else [])


def test_images_round_trip_and_damage_is_seen():
    for payload in (bytes(64), bytes(range(256)), b"x" * 640):
        image = media.to_image(payload)
        assert media.from_image(image).tobytes() == payload
        for at in (3, 20, len(image) // 2, len(image) - 20):
            broken = bytearray(image)
            broken[at] ^= 1
            with pytest.raises((ValueError, zlib.error)):
                media.from_image(bytes(broken))


def test_stored_media_are_read_back_whole(spark, tmp_path):
    docs = odd_documents(spark).withColumn("media", F.lit("clash")).repartition(3)
    media.store(docs, str(tmp_path / "m"), archive_bytes=2000)
    found = media.described(media.stored(spark, str(tmp_path / "m"), range_bytes=700, batch_bytes=500)).collect()
    expected = Counter()
    for r in docs.collect():
        text = (r.text or "").encode()
        payload = text + bytes(max(64, -(-len(text) // 64) * 64) - len(text))
        expected[r.doc_id, len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in found) == expected
    assert len({(r.payload_sha256, r.media_sha256, r.feature) for r in found}) == len({r.payload_sha256 for r in found})
    assert media.media_columns(docs.limit(0), folder=str(tmp_path / "none")).count() == 0


class Flaky:
    """A file whose first reads at some places are damaged."""

    def __init__(self, data: bytes, bad: int):
        self.data, self.bad, self.at, self.reads = data, bad, 0, 0

    def seek(self, at: int):
        self.at = at

    def read(self, n: int) -> bytes:
        self.reads += 1
        return b"?" * n if self.reads <= self.bad else self.data[self.at : self.at + n]


def test_members_are_retried_one_by_one(tmp_path):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("0_1_3.png", b"abc")
        archive.writestr("1_2_4.png", b"defg")
    data = out.getvalue()
    (a, n, crc, _), (b, m, crc2, _) = media.directory(io.BytesIO(data), len(data))
    reader = media.ArchiveReader({"path": "x", "retries": "2", "pause_seconds": "0"})
    assert reader.member(Flaky(data, 0), data, 0, b, m, crc2) == (b"defg", 1)
    damaged = data[: b + 35] + b"?" + data[b + 36 :]
    assert reader.member(Flaky(data, 0), damaged, 0, a, n, crc) == (b"abc", 1)
    assert reader.member(Flaky(data, 1), b"?" * len(data), 0, b, m, crc2) == (b"defg", 3)
    with pytest.raises(OSError):
        reader.member(Flaky(data, 9), b"", 0, a, n, crc)


def test_pipeline_stages_on_odd_rows_and_run(spark):
    docs = table(spark, SF, "documents").withColumn("score", F.lit("clash")).withColumn("component_id", F.lit(1)).withColumn("a.b", F.lit(2))
    odd = spark.createDataFrame([(900_001, None), (900_002, ""), (None, "xx yy zz"), (900_003, "12 34")], "doc_id long, text string")
    both = docs.unionByName(odd, allowMissingColumns=True)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near_duplicates", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, both, SF)
        assert name == "packing" or out.columns == both.columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert name != "language" or not ids & {900_001, 900_002, 900_003}
        assert stage(spark, both.limit(0), SF).count() == 0
    labels = table(spark, SF, "labels")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, SF).select("doc_id").collect()}
    assert good <= kept


def test_media_source_is_found_whichever_session_is_active(spark, tmp_path):
    sessions = spark._jvm.org.apache.spark.sql.SparkSession
    sessions.setActiveSession(spark.newSession()._jsparkSession)
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert media.media_columns(docs, folder=str(tmp_path / "m")).count() == 2


def test_groups_in_a_task_are_those_of_all_pairs():
    rng = random.Random(8)
    for _ in range(60):
        base = [rng.sample(range(400), rng.choice((3, 20, 60))) for _ in range(rng.randrange(1, 4))]
        sets = [np.array(sorted(set(rng.choice(base)) ^ set(rng.sample(range(400), rng.randrange(6))))) for _ in range(rng.randrange(2, 25))] + [np.zeros(0, np.int64)]
        for _ in range(3):  # chains: each a step from the one before
            sets.append(np.array(sorted(set(sets[-2 if len(sets[-1]) == 0 else -1].tolist()) ^ {rng.randrange(400)})))
        group = list(range(len(sets)))
        for i, j in combinations(range(len(sets)), 2):
            common = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if common * 100 >= (len(sets[i]) + len(sets[j]) - common) * 80 and min(len(sets[i]), len(sets[j])):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
        assert copies.groups_of(sets, 80) == group


def test_large_components_by_joins_give_the_same_rows(spark):
    """With no room in a task every component goes through the joins; rows that are there twice and odd texts change nothing."""
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(800)]
    texts = [rng.choices(words, k=120) for _ in range(12)]
    for t in texts[:9]:
        step = t
        for k in range(6):
            step = [*step[: 12 * k], f"new{k}", *step[12 * k + 1 :]]
            texts.append(step)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(None, None), (900, ""), (901, " ".join(texts[0])), (None, " ".join(texts[1])), (3, " ".join(texts[3]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small = Counter(tuple(r) for r in copies.keep_one(docs).collect())
    assert small == Counter(tuple(r) for r in copies.keep_one(docs, together=0).collect())
    group = by_shingles([(t or "").encode() for _, t in rows])
    assert sum(small.values()) == len(set(group))


def test_all_fingerprints_are_dealt_at_once_and_crowded_buckets_again(spark):
    rng = random.Random(6)
    base = [[rng.getrandbits(64) for _ in range(2)] for _ in range(40)]
    nodes = []
    for i, f in enumerate(base):
        nodes.append((i, *map(simhash.signed, f)))
        near = [x ^ 1 << rng.randrange(64) for x in f]
        nodes.append((100 + i, simhash.signed(near[0]), simhash.signed(rng.getrandbits(64))))
        nodes.append((200 + i, simhash.signed(rng.getrandbits(64)), simhash.signed(near[1])))
    df = spark.createDataFrame(nodes, "node long, f0 long, f1 long")
    expected = roots_of_nodes(nodes)
    for limit in (65536, 2):
        found = {r.node: r.root for r in simhash.components(copies.candidates(df, 2, 5, 8, limit)).collect()}
        assert {n: found.get(n, n) for n in expected} == expected


def roots_of_nodes(nodes):
    group = {n[0]: n[0] for n in nodes}
    for x, y in combinations(nodes, 2):
        if any(((a ^ b) & (1 << 64) - 1).bit_count() <= 5 for a, b in zip(x[1:], y[1:])):
            low, high = sorted((group[x[0]], group[y[0]]))
            group = {n: low if g == high else g for n, g in group.items()}
    return group


def test_columns_named_like_working_ones_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b", 7, 8, 9, 10), (2, "A  B", 1, 2, 3, 4), (3, "c", 5, 6, 7, 8)], "doc_id long, text string, __id int, __key int, kept_id int, __row_id int")
    for kept in (simhash.keep_one(docs), copies.keep_one(docs)):
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect())) == [(1, "a b", 7, 8, 9, 10), (3, "c", 5, 6, 7, 8)]


def test_thinned_edges_keep_every_component(spark):
    """A dense group costs one edge a member and not one for each way it was dealt, in one task or in several, and the components stay."""
    rng = random.Random(4)
    pairs = {(max(p), min(p)) for p in ((rng.randrange(300), rng.randrange(300)) for _ in range(6000)) if p[0] != p[1]}
    pairs |= {(1000 + i + 1, 1000 + i) for i in range(50)} | {(-5, -9), (3000, -9)}
    edges = spark.createDataFrame(sorted(pairs), "u long, v long").repartition(7)
    expected = {n: -9 for n in (-5, 3000, -9)} | {n: 1000 for n in range(1000, 1051)} | {n: 0 for n in range(300)}
    for together, most in ((1 << 20, 299 + 50 + 2), (1500, 4 * 351), (40, len(pairs))):
        less = simhash.thinned(edges, len(pairs), together)
        found = {(r.u, r.v) for r in less.collect()}
        assert found <= pairs and len(found) <= most
        assert {r.node: r.root for r in simhash.components(less.withColumnsRenamed({"u": "a", "v": "b"})).collect()} == expected

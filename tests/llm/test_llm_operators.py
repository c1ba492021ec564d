"""The training-data operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ratewright.llm import arrays, components, decontamination, packing, registry, sharding, simhash, substring_dedup, suffix_dedup, toxicity, url_filter, weak_quality, winnowing

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def corpus(seed=5):
    """(doc_id, text): shared passages, exact and near copies, repeated rows, null, empty, blank and very long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ日") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, line = prose(60), prose(13)
    texts = [prose(rng.randint(1, 150)) for _ in range(60)]
    texts += [f"{prose(5)} {passage} {prose(7)}", f"{passage}\n{prose(3)}", f"{prose(2)}\t{line}\x0b{prose(9)}", line, line.upper(), passage, passage, texts[3], texts[3] + " tail"]
    near = passage.split()
    near[30] = "zzz"
    texts += [" ".join(near), None, "", " \n ", "word", "ab " * 40, prose(30_000), "x" * 100_000]
    rows = list(enumerate(texts))
    return [*rows, rows[2], rows[61]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), i * 0.5, "m") for i, t in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, mark string").repartition(5).cache()


@pytest.fixture(scope="module")
def rows():
    return corpus()


def words_of(text):
    return WORD.findall((text or "").encode())


def test_word_bounds_and_hashes(rows):
    import pyarrow as pa

    data, offs = arrays.text_column(pa.array([t for _, t in rows]))
    start, end, first = arrays.words(data, offs)
    for i, (_, t) in enumerate(rows):
        assert [data[a:b].tobytes() for a, b in zip(start[first[i] : first[i + 1]], end[first[i] : first[i + 1]], strict=True)] == words_of(t)
    hashes = arrays.span_hash(arrays.prefix_hash(data), start, end)
    seen = {}
    for h, a, b in zip(hashes.tolist(), start, end, strict=True):
        assert seen.setdefault(h, data[a:b].tobytes()) == data[a:b].tobytes()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_toxicity_learns_marked_words(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "velit", "magna"]) for _ in range(40)) for _ in range(600)]
    labels = [int(i % 6 == 0) for i in range(600)]
    texts = [t + (" vileword " + t if y else "") for t, y in zip(base, labels, strict=True)] + [None, ""]
    d = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    l = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(0, 0), (9999, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(d, l.where(toxicity.fold() != 1))
    got = toxicity.score(d, model, score_col="p").withColumn("held", toxicity.fold() == 1).toPandas()
    held = got[got.held & (got.doc_id < 600)]
    assert (held.predicted == [labels[i] for i in held.doc_id]).mean() > 0.98
    assert got.p.between(0, 1).all() and len(got) == 602
    alone = toxicity.train(d, l.where("toxic = 0"))
    assert toxicity.score(d, alone, score_col="p").where("p >= 0.7").count() == 0
    assert toxicity.score(d.limit(0), model, score_col="p").count() == 0


def test_winnowing_guarantee_and_ties():
    rng = random.Random(3)
    k, w = winnowing.GRAM, winnowing.WINDOW
    for _ in range(30):
        shared = "".join(rng.choice("ab é") for _ in range(w + k - 1))
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(300))) + shared
        b = shared + "".join(rng.choice("abc") for _ in range(rng.randrange(300)))
        assert set(winnowing.winnow(winnowing.code_points(a))[0].tolist()) & set(winnowing.winnow(winnowing.code_points(b))[0].tolist())
    h, at = winnowing.winnow(winnowing.code_points("a" * 1000))
    assert len(set(h.tolist())) == 1 and (np.diff(at) == 1).all() and at[0] == w - 1  # equal hashes: the rightmost of each window
    assert len(winnowing.winnow(winnowing.code_points(""))[0]) == 0


def test_winnowing_of_short_texts_has_the_same_gram():
    a, b = (set(winnowing.winnow(winnowing.code_points(t))[0].tolist()) for t in ("abcdefghijklmno", "abcdefghijklmnop"))
    assert a & b or len(a | b) == 2
    sets = [set(winnowing.winnow(winnowing.code_points("abcdefghijklmnopqrstuvwxyz"[:n]))[0].tolist()) for n in range(1, 24)]
    assert all(len(x) == 1 for x in sets) and len(set.union(*sets[7:])) < 16  # one window each; longer texts keep a smallest gram


def test_winnowing_neighbours_of_a_repeated_id(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(None, f"none {i} {'x' * (i % 50)}") for i in range(300)] + [(7, f"seven {i}") for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = [r.text for r in d.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text")).collect()]
    expected = Counter()
    for n, t in enumerate(order):
        cut = len(t) // 3
        expected[hashlib.sha256((t[: len(t) - cut] + order[(n + 1) % len(order)][:cut]).encode()).hexdigest()] += 1
    assert Counter(r.edited_sha256 for r in winnowing.with_edited_neighbour(d).collect()) == expected


def test_winnowing_neighbours(docs, rows):
    got = winnowing.with_edited_neighbour(docs).toPandas()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    assert len(got) == len(rows)
    expected = Counter()
    for n, (i, t) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        cut = len(t) // 3
        expected[i, len(t), hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest()] += 1
    unique = {i for i, c in Counter(i for i, _ in rows).items() if c == 1}
    assert {k for k in expected if k[0] in unique} == {(r.id, r.n_chars, r.edited_sha256) for r in got.itertuples() if r.id in unique}
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    by_text = {}
    for r in got.itertuples():
        assert by_text.setdefault(dict(rows)[r.id] or "", r.fingerprint) == r.fingerprint
    assert winnowing.with_edited_neighbour(docs.limit(0)).count() == 0
    alone = winnowing.with_edited_neighbour(docs.where("doc_id = 5")).first()
    assert alone.near_next == 1.0


def brute_windows(rows, window):
    first, split = {}, [(i, words_of(t)) for i, t in rows]
    for i, ws in split:
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, ws in split:
        keep = np.ones(len(ws), bool)
        for k in range(len(ws) - window + 1):
            if first[tuple(ws[k : k + window])] < i:
                keep[k : k + window] = False
        out[i, len(ws), int((~keep).sum()), b" ".join(w for w, y in zip(ws, keep, strict=True) if y).decode()] += 1
    return out


@pytest.mark.parametrize(("window", "chunk"), [(7, 2_000_000), (13, 2_000_000), (13, 300)])
def test_substring_dedup(docs, rows, window, chunk, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    got = substring_dedup.remove_repeats(docs, window=window).select("row.*", "n_words", "n_removed", "kept").collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_windows(rows, window)
    assert {(r.doc_id, r.score, r.mark) for r in got} == {(r.doc_id, r.score, r.mark) for r in docs.collect()}


def test_substring_dedup_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(empty).count() == 0
    text = " ".join(map(str, range(20)))
    d = spark.createDataFrame([(None, text), (4, text), (4, "x " + text), (9, text)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(d).select("row.doc_id", "n_removed").collect())
    assert got == Counter({(None, 0): 1, (4, 0): 2, (9, 20): 1})


def test_difference_cover():
    diffs = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert diffs == set(range(substring_dedup.PERIOD))


def brute_bytes(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "cells"), [(100, 1000), (100, 3)])
def test_suffix_dedup(docs, rows, length, cells, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CELLS", cells)
    some = [(i, t) for i, t in rows if len(t or "") < 20_000]
    got = suffix_dedup.remove_repeated_bytes(docs.where("n_chars < 20000"), length=length).collect()
    expected = Counter((i, *x) for (i, _), x in zip(some, brute_bytes([(t or "").encode() for _, t in some], length), strict=True))
    assert Counter((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected


def test_suffix_ranks_equal_string_classes():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[500:900] = text[1500:1900]
    starts = np.arange(0, 3000 - 64)
    rank = suffix_dedup.depth_ranks(text, starts, 64)
    strings = [text[s : s + 64].tobytes() for s in starts]
    assert len({*zip(rank.tolist(), strings, strict=True)}) == len(set(strings)) == len(set(rank.tolist()))
    order = np.argsort(rank, kind="stable")
    assert [strings[i] for i in order] == sorted(strings)


def test_suffix_dedup_of_one_text_and_none(spark):
    d = spark.createDataFrame([(1, "q" * 401), (2, "r" * 400), (None, "q" * 500)], "doc_id long, text string")
    got = {r.id: r.n_removed for r in suffix_dedup.remove_repeated_bytes(d).collect()}
    assert got == {1: 401, 2: 0, None: 0}
    assert suffix_dedup.remove_repeated_bytes(d.limit(0)).count() == 0


def test_url_filter(spark):
    pages = [
        (1, "http://A.example.org/es/x?q#f", "<link rel='canonical' href='http://k.net/1'>"),
        (2, "http://k.net/1#z", ""),
        (3, "http://k.net/2", '<meta http-equiv="refresh" content="0; url=http://k.net/1">'),
        (4, None, None),
        (5, "foo", ""),
        (6, "http://x.org", "x"),
        (7, "http://example.org/en/12", None),
        (8, "http://k.com/de/1", '<link href="http://k.com/fr/9" rel="canonical">'),
        (9, "http://j.net/1", '<link href="http://k.com/fr/9" rel="canonical"><link href="http://k.com/de/9" rel="canonical">'),
        (9, "http://j.net/1", '<link href="#here" rel="canonical"><link href="mailto:x@k.com/de/1" rel="canonical">'),
        (10, "https://sub.notexample.org/", ""),
    ]
    d = spark.createDataFrame([(*p, "h", 1) for p in pages], "page_id long, url string, html string, host string, path int")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(d).collect())
    expected = [
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "k.net", "/1", None, "block"), (3, "k.net", "/2", None, "block"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "x.org", "", None, "allow"), (7, "example.org", "/en/12", "example.org/en/1", "block"), (8, "k.com", "/de/1", "com/de/", "block"), (9, "j.net", "/1", None, "allow"), (9, "j.net", "/1", None, "allow"),
        (10, "sub.notexample.org", "/", "org/", "allow"),
    ]
    assert got == expected
    assert url_filter.judge(d.limit(0)).count() == 0


def test_relative_and_quoted_targets(spark):
    page = lambda k, path, html: (k, f"http://k.com{path}", html, "a", "b")
    link = '<link rel="nofollow canonical" href="{}">'.format
    pages = [
        page(1, "/a/b", link("/de/1")), page(2, "/a/c?x", link("../de/./2?y=1&amp;z=2")), page(3, "/d", link("//k.com/de/3")), page(4, "/a/e", link("/x/../de/4#f")),
        page(5, "", link("de/5")), page(6, "/a/f", "<meta http-equiv=refresh content=\"0; URL='/de/6'\">"), page(7, "/a/g", "<META content='0;url=\"http://k.com/de/7\"' http-equiv='Refresh'>"),
        page(8, "/a/h", "<meta http-equiv=refresh content=0;url=/de/8>"), page(9, "/a/i", link("/ok?u=http://k.com/de/1")), page(10, "/de/2?y=1&z=2", ""), page(11, "/a/j", link("?q") + "x" * 3_000_000),
        page(12, "/a/j?q", link("../../../de/")), page(13, "/a/k", link("http://k.com/ok")), page(14, "/ok", "<a href='/de/1' rel=canonical>"),
    ]
    d = spark.createDataFrame(pages, "page_id long, url string, html string, _host string, node string")
    got = url_filter.judge(d)
    assert got.columns == ["page_id", "url", "_host", "node", "host", "path", "rule", "verdict"]
    blocked = {1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12}
    assert {r.page_id for r in got.where("verdict = 'block'").collect()} == blocked
    duckdb = pytest.importorskip("duckdb")
    pages = d.select("page_id", "url", "html").toPandas()  # noqa: F841 - the SQL reads it
    assert {r[0] for r in duckdb.sql(registry.ORACLES["op5_redirect_equivalence"]).fetchall() if r[4] == "block"} == blocked


def test_weak_quality_parts_junk_from_prose(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9)))
    sentence = lambda: " ".join(word() for _ in range(9)).capitalize() + "."
    good = [" ".join(sentence() for _ in range(rng.randint(4, 20))) for _ in range(300)]
    junk = [g.upper() + "!!" for g in good[:15]] + [" | ".join(g.split()) for g in good[15:30]] + [g.replace(" ", "%%% ") for g in good[30:45]] + [" ".join(w for w in g.split()[:6] for _ in range(12)) for g in good[45:60]]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(good + junk + [None, "", " "])], "doc_id long, text string")
    got = {r.doc_id: r for r in weak_quality.judge(d).collect()}
    assert sum(got[i].keep for i in range(300)) >= 294
    assert sum(got[i].keep for i in range(300, 360)) <= 3
    assert not any(got[i].keep for i in (360, 361, 362)) and len(got) == 363
    assert weak_quality.judge(d.limit(0)).count() == 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    votes = np.where(rng.random((20_000, 5)) < 0.3, 0, np.where(rng.random((20_000, 5)) < 0.85, 1, -1) * np.where(truth, 1, -1)[:, None])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    good, table, prior = weak_quality.label_model(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.05 and np.abs(table[1, :, 2] / (table[1, :, 2] + table[1, :, 0]) - 0.85).max() < 0.05


def test_shards(docs, rows):
    got = sharding.shard_by_bytes(docs.where("n_chars < 20000"), 6, parts=3).toPandas()
    some = [(i, t) for i, t in rows if len(t or "") < 20_000]
    assert Counter(got.doc_id) == Counter(i for i, _ in some)
    assert (got["size"] == [len((dict(rows)[i] or "").encode()) + 8 for i in got.doc_id]).all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 2 * got["size"].max() + 0.01 * sizes.mean()
    assert sharding.shard_by_bytes(docs.limit(0), 6).count() == 0


def test_shards_split_a_large_group_of_copies(spark):
    d = spark.createDataFrame([(i, "same text" if i % 3 else f"text {i}") for i in range(3000)], "doc_id long, text string")
    sizes = sharding.shard_by_bytes(d, 8).groupBy("shard").agg(F.sum("size").alias("n")).toPandas().n
    assert len(sizes) == 8 and sizes.max() / sizes.min() < 1.02


@pytest.mark.parametrize("name", ["_key", "_who", "_size", "_row", "_part", "_base", "_n", "row"])
def test_shards_leave_the_callers_columns(spark, name):
    d = spark.createDataFrame([(i, f"text {i % 7}", f"own {i}") for i in range(60)], f"doc_id long, text string, {name} string")
    got = sharding.shard_by_bytes(d, 3).collect()
    assert len(got) == 60 and all(r[name] == f"own {r.doc_id}" and r.text == f"text {r.doc_id % 7}" for r in got)


def brute_simhash(text):
    ws = words_of((text or "").encode().lower().decode())
    shingles = [b" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([b" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(fps):
    ids = sorted(fps)
    a = np.array([fps[i] for i in ids], np.uint64)
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2)
    label = arrays.min_labels(i, j, len(ids))
    return {ids[k]: ids[label[k]] for k in range(len(ids))}


def test_simhash(docs, rows):
    some = [(i, t) for i, t in rows if len(t or "") < 20_000]
    fps = {i: brute_simhash(t) for i, t in some}
    got = simhash.near_duplicates(docs.where("n_chars < 20000")).collect()
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == fps and len(got) == len(some)
    assert {r.doc_id: r.component_id for r in got} == brute_groups(fps)
    kept = simhash.keep_one(docs.where("n_chars < 20000"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(brute_groups(fps).values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [256, 4])
def test_golay_links_every_near_pair(spark, most, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_RUN", most)
    rng = np.random.default_rng(9)
    fps = set()
    for _ in range(60):
        f = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 12))):
            fps.add(f)
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                f ^= 1 << int(b)
    nodes = {f: f for f in fps}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"))
    got = {r.node & (1 << 64) - 1: r.root for r in components.connected_components(links, "fp", "link").collect()}
    expected = brute_groups(nodes)
    ours, theirs = {}, {}
    for f in fps:
        ours.setdefault(got.get(f, ("alone", f)), set()).add(f)
        theirs.setdefault(expected[f], set()).add(f)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def shingles(text):
    ws = words_of(text.lower()) if text else []
    return {b" ".join(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))} if ws else frozenset()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def kept_of(rows, least=0.8):
    """The smallest id of each group linked by pairs of that likeness, over all pairs."""
    sets, label = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}
    holders = {}
    for i, x in sets.items():
        for h in x or {b""}:
            holders.setdefault(h, []).append(i)
    for i, x in sets.items():
        for j in {j for h in x or {b""} for j in holders[h] if j < i}:
            both = len(x & sets[j])
            if both >= least * (len(x) + len(sets[j]) - both):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    return set(label.values())


@pytest.mark.parametrize(("parts", "block"), [(1, 4096), (7, 4096), (3, 2)])
def test_near_copies(spark, parts, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    rows = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(30, 400))]
        for _ in range(rng.randint(1, 5)):
            text = list(base)
            for _ in range(rng.randint(0, len(base) // 40)):  # 0.8 is one word in 45
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (902, "one", "x"), (903, "one two", "x"), (904, "two one", "x"), (904, "two one", "x"), (905, "One", "x")]
    rows += [(906, " ".join(words[:400] * 100), "x"), (907, " ".join(words[:400] * 90), "x"), (908, "z" * 3_000_000, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(parts)
    kept = simhash.keep_one_near_copy(d)
    got = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == d.columns and all(n == (2 if i == 904 else 1) for i, n in got.items())
    assert set(got) == kept_of([(i, t) for i, t, _ in rows])
    assert simhash.keep_one_near_copy(d.limit(0)).count() == 0


@pytest.mark.parametrize("words", [8, 9, 12, 20])
def test_near_copies_of_few_words(spark, words):
    """Sets of few shingles: a text and the same with a word more, from four shingles of five on."""
    rng = random.Random(words)
    word = lambda: "".join(rng.choice("abcdefgiklmnorstu") for _ in range(6))
    rows = []
    for g in range(300):
        text = " ".join(word() for _ in range(words))
        rows += [(2 * g, text), (2 * g + 1, f"{text} {word()}")]
    kept = {r.doc_id for r in simhash.keep_one_near_copy(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(range(0, 600, 2)) <= kept and len(kept) <= 300 + 6  # recall of 0.98 or more at the very threshold


@pytest.mark.parametrize("small", [2_000_000, 0])
def test_hubs_in_components(spark, small, monkeypatch):
    monkeypatch.setattr(components, "SMALL", small)
    monkeypatch.setattr(components, "SHARE", 4)
    links = [(0, i) for i in range(1, 900)] + [(i, i + 1) for i in range(1000, 1100)] + [(899, 1050), (2000, 2001), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in [*range(900), *range(1000, 1101)]}, 2000: 2000, 2001: 2000}


def test_shared_keys_over_batches():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    key = np.sort(np.r_[rng.integers(0, 400, 900), np.full(7000, 500), np.full(2, 600), 700])
    node = np.arange(len(key))
    n = Counter(key.tolist())
    expected = [(k, i) for k, i in zip(key.tolist(), node.tolist(), strict=True) if n[k] > 1]
    for step in (1, 1000, 80_000):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + step]), pa.array(node[i : i + step])], names=["key", "node"]) for i in range(0, len(key), step)]
        got = [r for b in simhash._shared_keys(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert got == expected


def test_near_copies_with_blocks_added_or_cut(spark):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefgiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows, alike = [], {}
    for g in range(120):
        base, share = prose(rng.randint(100, 400)), rng.uniform(0.02, 0.28)
        n = int(len(base.split()) * share)
        edited = (f"{base} {prose(n)}", " ".join(base.split()[: -n - 1]), f"{prose(n)} {base}")[g % 3]
        rows += [(2 * g, base), (2 * g + 1, edited)]
        alike[2 * g + 1] = likeness(base, edited) >= 0.8
    kept = {r.doc_id for r in simhash.keep_one_near_copy(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert 30 < sum(alike.values()) < 110 and kept == {i for i, _ in rows if not alike.get(i, False)}


@pytest.mark.parametrize("block", [4096, 20])
def test_near_copies_in_a_large_key_are_all_compared(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(22)
    word = lambda: "".join(rng.choice("abcdefgiklmnorstu") for _ in range(8))
    stem = " ".join(word() for _ in range(100))
    tails = [" ".join(word() for _ in range(40)) for _ in range(100)]  # likeness of two families about 0.55
    rows = [(3 * f + k, f"{stem} {t} {' '.join(word() for _ in range(k))}") for f, t in enumerate(tails) for k in range(3)]
    kept = {r.doc_id for r in simhash.keep_one_near_copy(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert kept == set(range(0, 300, 3))


def test_golay_code_is_perfect():
    g = simhash.golay()
    assert len({*map(int, g.leaders[:, 0])}) == 2048 and max(int(x).bit_count() for x in g.leaders[:, 0]) == 3
    v = np.arange(0, 1 << 23, 997)
    for bit in range(23):
        a, b = g.keys(v), g.keys(v ^ (1 << bit))
        assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).all()


def test_decontamination(spark):
    question = "In a small town Alice bought 12 apples and gave 5 kg to Bob before the market closed at noon while Alice waited"
    d = spark.createDataFrame(
        [
            (1, "xx yy " + question + " zz", "a"),
            (2, question.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "99").replace("5 kg", "7 lb"), "a"),
            (3, question.replace("Alice", "Carol", 1), "a"),  # one name filled in two ways
            (4, "Numbers 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20", "a"),
            (5, None, "a"), (6, "", "a"), (7, "entirely other words that no question of the benchmark would ever hold in any order", "a"),
            (1, "a second row under one id", "a"), (None, question, "a"),
            (8, "what is the capital city", "a"),
        ],
        "doc_id long, text string, item_id string",
    )
    bench = spark.createDataFrame([(10, question), (11, "1 2 3 4 5 6 7 8 9 10 11 12"), (12, None), (13, "two words"), (14, "What is the capital city?"), (10, question)], "item_id long, text string")
    for small in (decontamination.SMALL_BENCHMARK, 0):
        saved, decontamination.SMALL_BENCHMARK = decontamination.SMALL_BENCHMARK, small
        try:
            got = sorted((r.doc_id, r.item_id) for r in decontamination.leaks(d, bench).collect())
        finally:
            decontamination.SMALL_BENCHMARK = saved
        assert got == [(1, 10), (2, 10), (8, 14)]
    left = decontamination.without_leaks(d, bench)
    assert left.columns == d.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 3, 4, 5, 6, 7]
    assert decontamination.leaks(d.limit(0), bench).count() == 0 and decontamination.leaks(d, bench.limit(0)).count() == 0


def found_leaks(spark, texts, items):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontamination.leaks(d, b).collect())


def test_verbatim_items_with_few_plain_words_are_found(spark):
    items = ["What is 12 * 7 + 5?", "red, Paris", "the Quick Brown Fox of New York City by Tom", "3 1 4 1 5 9 2 6", "Add 5 to 7"]
    texts = [f"some words go first here. {t} and other words come last" for t in items]
    texts += [t.replace("12", "13").replace("Paris", "Rome").replace("York", "Delhi").replace("9", "8").replace("Add 5", "Add 6") for t in texts[:5]]
    assert found_leaks(spark, texts, items) == [(i, i) for i in range(5)]


def test_items_with_longer_fillings_and_odd_slots_are_found(spark):
    word = iter(f"w{''.join(chr(97 + int(c)) for c in str(k))}" for k in range(1000))
    prose = lambda n: " ".join(next(word) for _ in range(n))
    parts = [prose(11) for _ in range(3)]
    item = f"{parts[0]} Alice {parts[1]} 1200 {parts[2]}"
    a, b, c = prose(20), prose(24), prose(10)
    passage = f"{a} Alice {b} Alice {c}"
    texts = [
        f"{prose(9)} {parts[0]} Mary Ann {parts[1]} 1 200 {parts[2]} {prose(9)}",
        f"{parts[0]} Alice added {parts[1]} 1200 more {parts[2]}",
        f"{prose(5)} {a} Alice {b} Carol {c}",
        f"{parts[0][:30]} {prose(30)}",
    ]
    assert found_leaks(spark, texts, [item, passage]) == [(0, 0), (1, 0), (2, 1)]


def test_two_item_values_may_get_one_filling(spark):
    item = "a train leaves the station with 3 cars full of coal and later takes on 5 more cars at the next stop before noon"
    texts = [item.replace("3", "4").replace("5", "4"), item.replace("3", "5").replace("5", "3", 1), "nothing " + " ".join(item.split()[:6])]
    assert found_leaks(spark, texts, [item]) == [(0, 0), (1, 0)]


def test_questions_with_other_parameters_are_found(spark):
    """Recall of re-parameterised questions and precision on other ones of the same words, names at sentence starts included."""
    rng = random.Random(17)
    names, units, words = ["Alice", "Bob", "Carol", "Dmitri", "Eve", "Farid", "Grace"], ["kg", "miles", "hours", "liters"], [f"{a}{b}" for a in ("ra", "lo", "mi", "te", "su") for b in ("ban", "der", "fil", "gon", "hut", "kem")]

    def question():
        out = []
        for _ in range(rng.randint(3, 5)):
            ws = [rng.choice(words) for _ in range(rng.randint(8, 14))]
            ws[rng.randrange(2, len(ws) - 1)] = "{n%d}" % rng.randrange(3)
            ws[rng.randrange(2, len(ws) - 1)] = "{u}"
            out.append(" ".join(["{a}", *ws] if rng.random() < 0.6 else [ws[0].capitalize(), *ws[1:], "{b}"]) + ".")
        return " ".join(out)

    def filled(q):
        a, b = rng.sample(names, 2)
        return q.format(a=a, b=b, u=rng.choice(units), n0=rng.randint(2, 99), n1=rng.randint(2, 99), n2=rng.randint(2, 99))

    questions = [question() for _ in range(60)]
    others = [question() for _ in range(60)]
    noise = lambda: " ".join(rng.choice(words) for _ in range(30))
    texts = [f"{noise()}. {filled(q)} {noise()}" for q in questions + others]
    got = set(found_leaks(spark, texts, [filled(q) for q in questions]))
    assert len({(i, i) for i in range(60)} & got) >= 57 and len(got - {(i, i) for i in range(60)}) <= 1


def test_window_filter_holds_every_hash(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "FILTER_BITS", (17, 18))
    hashes = np.random.default_rng(6).integers(-(1 << 63), 1 << 63, 5000)
    bits = decontamination._hash_filter(spark.createDataFrame([(int(h),) for h in hashes], "hash long"), 5000)
    at = hashes & (8 * len(bits) - 1)
    assert (bits[at >> 3] >> (at & 7) & 1).all() and np.bitwise_count(bits).sum() == len(np.unique(at))


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    inner = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for i, t in rows:
        ids = np.array([*inner.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            expected[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = packing.pack_documents(docs, VOCABULARY, capacity=512, with_ids=True).toPandas()
    assert Counter(zip(got.id, got.piece, got.start, got.length, got.ids_crc32, strict=True)) == expected
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got.itertuples())
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= 512
    assert packing.pack_documents(docs.limit(0), VOCABULARY).count() == 0


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(2)
    for n in (1, 7, 3000):
        sizes, counts = np.unique(np.minimum(rng.lognormal(4, 1, n).astype(int) + 1, 512), return_counts=True)
        histogram = dict(zip(sizes.tolist(), counts.tolist(), strict=True))
        got, sequences = Counter(), 0
        for pattern, times in packing.solve_patterns(histogram, 512, 60):
            assert sum(s * c for s, c in pattern) <= 512
            sequences += times
            for s, c in pattern:
                got[s] += c * times
        assert got == Counter(histogram)
        assert sequences <= -(-sum(s * c for s, c in histogram.items()) // 512) * 1.05 + 2


@pytest.mark.parametrize(
    ("histogram", "capacity", "gap"),
    [
        ({47: 600, 27: 600, 26: 600}, 100, 0.0),  # only 47 + 27 + 26 fills a sequence; best fit, longest first, needs 700
        ({366: 3001}, 1024, 0.0),
        ({375: 3000, 325: 2000, 275: 4000, 175: 900}, 1024, 0.01),
        ({205 + k: 40 + k % 7 for k in range(300)}, 1024, 0.05),
        ({1: 5000, 1023: 5000}, 1024, 0.0),
    ],
)
def test_packing_is_near_the_programs_bound(histogram, capacity, gap):
    patterns, bound = packing.solve_with_bound(histogram, capacity)
    got = Counter()
    for pattern, times in patterns:
        assert sum(s * c for s, c in pattern) <= capacity
        for s, c in pattern:
            got[s] += c * times
    assert got == Counter(histogram)
    assert bound >= -(-sum(s * c for s, c in histogram.items()) // capacity)
    assert bound <= sum(n for _, n in patterns) <= bound * (1 + gap) + 1
    assert packing.solve_patterns({}) == []


def test_tokenizer_by_words_equals_the_library():
    import pyarrow as pa

    texts = ["It's a don't  l'État ÅÅ İstanbul ΣΑΣ naïve café café 12kg $5.00!! <|endoftext|>b 'S WE'RE É,È. \x1c\x1fq “q” 日本語 👍🏽", "ﬁ ﬃ Ⅷ ² ½ Å K ẞ ǅ ſt", "", "a,b;c.d!e?f:g (h) [i]"]
    t = packing.WordTokenizer(VOCABULARY)
    for _ in range(2):
        ids, first = t.encode(*arrays.text_column(pa.array(texts)))
        for i, e in enumerate(t.inner.encode_batch(texts, add_special_tokens=False)):
            assert ids[first[i] : first[i + 1]].tolist() == e.ids

"""Source divergence against a plain count over nulls, repeated rows, ties, empty groups and clashing columns."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratewright.llm import divergence
from ratewright.llm.arrays import text_column

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, top=divergence.TOP):
    """Every kept term in every group, without cells."""
    in_group, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups[lang].add(source)
        in_group[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        whole = sum((in_group[lang, s] for s in sources), Counter())

        def share(counts, kept=kept):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (size + len(kept)) for t in kept}

        p = {s: share(in_group[lang, s]) for s in sources}
        q = share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            tops = [(f(p[s][t], q[t]), t) for t in kept if in_group[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", tops)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[: None if part == "pair" else top]
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)}
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÉß日Z") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    prose = lambda n: "".join(rng.choice(words) + rng.choice([" ", "1", "_", "\n", "\x7f", "[", "é "]) for _ in range(n))
    rows = [(prose(rng.randint(0, 40)), rng.choice(["en", "de", None]), rng.choice(["hot"] * 5 + ["s1", "s2", None])) for _ in range(150)]
    rows += [(prose(30_000), "en", "long"), (None, "en", "bare"), ("", "en", "bare"), ("12 34", "fr", "a"), ("x", "fr", "b"), ("alone", "xx", "only"), ("one two", "xx", "only"), (None, None, None)]
    return rows + rows[:7]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 5, 7.5, "m") for r in rows], "text string, lang string, source string, n long, value double, term string").repartition(7)
    got = [tuple(r) for r in divergence.audit(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


@pytest.mark.parametrize("top", [1, 3])
def test_ties_at_the_last_rank_go_by_bytes(spark, top):
    names = ["b", "é", "a", "日", "zz"]
    rows = [(" ".join(names), "en", "s")] * 3 + [("other words here", "en", "t")] * 3
    got = {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), top=top).collect()}
    assert got == brute(rows, top)


def test_no_documents_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_terms_of_a_chunk():
    texts = ["Ab9éÉ", "", "x", "yZ", None, "..", "日本 a"]
    data, offsets = text_column(pa.array(texts))
    words, row = divergence._terms(data, offsets)
    assert list(zip(row.tolist(), words.to_pylist(), strict=True)) == [(i, t) for i, x in enumerate(texts) for t in terms(x)]


def test_shares_of_huge_counts_are_exact(spark):
    n, size, kept = 5 * 10**11, 9 * 10**17, 10**6
    found = spark.range(1).select(F.lit(n).alias("n"), F.lit(size).alias("size"), F.lit(kept).alias("kept")).select(divergence._share("n", "size").alias("p")).first()[0]
    assert found == 1 + 10**9 * (n + 1) // (size + kept)

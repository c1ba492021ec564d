"""The corpus pipeline on a small folder with planted cases."""

import random

import pytest

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item, passage = prose(30), prose(80)
    docs = [[i, prose(120)] for i in range(300)]
    for i in range(0, 300, 5):
        docs[i][1] += " hatefulword and hatefulword"
    docs += [[300, docs[1][1]], [301, docs[2][1] + " x"], [302, f"{prose(60)} {passage} {prose(20)}"], [303, f"{prose(10)} {passage} {prose(70)}"], [304, f"{prose(40)} {item} {prose(40)}"], [305, None], [306, ""]]
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "extra") for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    toxic = {i for i in range(0, 300, 5)}
    assert len(toxic & ids["toxicity"]) <= 3 and set(range(307)) - toxic <= ids["toxicity"]
    assert 300 not in ids["simhash_near_dedup"] and 1 in ids["simhash_near_dedup"]
    texts = {r.doc_id: r for r in seen["substring_dedup"].collect()}
    assert len(texts[302].text.split()) == 160 and len(texts[303].text.split()) == 80 and texts[303].n_chars == len(texts[303].text)
    assert ids["substring_dedup"] - ids["benchmark_decontamination"] == {304}
    assert ids["best_fit_packing"] == ids["benchmark_decontamination"]
    total = corpus_pipeline.run(spark, folder)
    assert sorted(total.select("doc_id", "piece", "length").collect()) == sorted(seen["best_fit_packing"].select("doc_id", "piece", "length").collect())


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
        if "sequence_id" in docs.columns:
            break

"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ratewright.llm import decontamination, divergence, packing, sharding, simhash, substring_dedup, suffix_dedup, toxicity, url_filter, warc, weak_quality, whitening, winnowing


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _docs(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs.where(toxicity.fold() != 1), labels.where(toxicity.fold() != 1))
    return toxicity.score(docs, model).select("doc_id", (toxicity.fold() == 1).alias("held_out"), "score", "predicted")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.with_edited_neighbour(_docs(spark, sf_dir).select("doc_id", "text"))
    return out.withColumnRenamed("id", "doc_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_docs(spark, sf_dir).select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(_docs(spark, sf_dir).select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op6_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.judge(_docs(spark, sf_dir))


def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    out = sharding.shard_by_bytes(docs, 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_docs(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(_docs(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return out.withColumnRenamed("id", "doc_id")


def op11_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "url", "html")
    return out.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_docs(spark, sf_dir))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_winnowing": op2_winnowing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_redirect_equivalence": op5_redirect_equivalence,
    "op6_weak_quality": op6_weak_quality,
    "op7_histogram_sort": op7_histogram_sort,
    "op8_simhash_golay": op8_simhash_golay,
    "op9_decontamination": op9_decontamination,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_warc_revisits": op11_warc_revisits,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op3_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS k FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
earliest AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN earliest USING (k), unnest(range(0, 13)) AS u(j) WHERE m < doc_id),
each AS (SELECT doc_id, p, ws[p] AS x FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op5_redirect_equivalence": r"""
WITH RECURSIVE parts_of_pages AS (
  SELECT DISTINCT url, html, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS p FROM pages WHERE url LIKE '%://%'),
written AS (
  SELECT url, h, p, replace(unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\brel\s*=\s*("[^"]*\bcanonical\b|''[^'']*\bcanonical\b|canonical\b)')),
                   lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<meta\b[^>]*>'), lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
                   lambda x: regexp_extract(regexp_extract(x, '(?is)\bcontent\s*=\s*("[^"]*"|''[^'']*''|[^\s>]+)', 1), '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)))), '&amp;', '&') AS t
  FROM parts_of_pages WHERE h <> ''),
joined AS (
  SELECT *, CASE WHEN starts_with(t, '/') THEN regexp_extract(t, '(?s)^([^?#]*)', 1)
    ELSE coalesce(nullif(regexp_extract(p, '(?s)^(.*/)', 1), ''), '/') || regexp_extract(t, '(?s)^([^?#]*)', 1) END AS j, row_number() OVER () AS n
  FROM written WHERE t <> ''),
-- one path segment a step: '..' takes the last one away
walk(n, k, done) AS (
  SELECT n, 2, ['']::VARCHAR[] FROM joined
  UNION ALL
  SELECT walk.n, k + 1, CASE string_split(j, '/')[k] WHEN '.' THEN done WHEN '..' THEN CASE WHEN len(done) > 1 THEN done[:-2] ELSE done END ELSE list_append(done, string_split(j, '/')[k]) END
  FROM walk JOIN (SELECT n, CASE WHEN regexp_matches(j, '/\.\.?$') THEN j || '/' ELSE j END AS j FROM joined) USING (n) WHERE k <= len(string_split(j, '/'))),
walked AS (SELECT n, array_to_string(max_by(done, k), '/') AS j FROM walk GROUP BY n),
tags AS (
  SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN starts_with(t, '#') OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(t, '?') THEN 'http://' || h || p || t
    ELSE 'http://' || h || walked.j || regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) END AS target
  FROM joined JOIN walked USING (n)),
urls AS (SELECT url FROM pages WHERE url LIKE '%://%' UNION SELECT target FROM tags WHERE target LIKE '%://%'),
parts AS (
  SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(?s)^[^#]*?(\?[^#]*)', 1) AS query FROM urls),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
ruled AS (SELECT url, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url),
node AS (SELECT url, host, path, host || path || query AS a, rule, verdict FROM parts LEFT JOIN ruled USING (url) WHERE host <> ''),
edges AS (SELECT x.a, y.a AS b FROM tags JOIN node x USING (url) JOIN node y ON y.url = target WHERE x.a <> y.a),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
inherited AS (SELECT r.a, min(n.verdict) AS verdict FROM reach r JOIN node n ON n.a = r.b GROUP BY r.a)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(n.verdict, i.verdict, 'allow') AS verdict
FROM pages LEFT JOIN node n USING (url) LEFT JOIN inherited i USING (a)""",
    "op11_warc_revisits": r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS original FROM pages)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  -- five hexadecimal digits are four of base32
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> original THEN original END AS refers_to
FROM p""",
    "op13_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(total) AS l FROM kept GROUP BY lang),
sizes AS (SELECT g.*, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) AS n_all, coalesce(v, 0) AS v, coalesce(l, 0) AS l FROM g LEFT JOIN v USING (lang)),
-- every kept term in every group of its language
p AS (SELECT s.lang, s.source, kept.term, coalesce(c.n, 0) AS n, (1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (s.n_all + s.v)::HUGEINT)::HUGEINT AS p,
    (1 + (1000000000 * (total + 1)::HUGEINT) // (s.l + s.v)::HUGEINT)::HUGEINT AS q FROM sizes s JOIN kept USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(pair.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}

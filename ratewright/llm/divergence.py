"""Where sources differ in their words: every (lang, source) group against its language and against the language's other sources.

Terms are runs of letters and of code points above 0x7F, A-Z lower-cased; a null text, lang or source is the empty string.  A language keeps
the terms that at least `least_docs` of its documents hold.  A term's share in a group is p = 1 + floor(SCALE (count + 1) / (N + V)), where
N is the group's number of kept terms, repeats included, and V the language's number of different ones; two shares differ by
f = floor((p - q)^2 / q).

f depends on two counts only, so terms are grouped by their counts and f is taken once per cell of equal counts.  Cells, not terms, are ranked: a cell's
multiplicity says how many ranks it takes, cells of one value are merged, and only the cells that reach the wanted ranks are expanded
to their terms, in UTF-8 order.  For a pair of sources only terms that both hold are joined; what one side lacks follows from the
histograms of counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.arrays import releasing, row_chunks, text_column
from ratewright.sources.io import shared_folder

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_COUNTED = "lang string, source string, term string, n bigint, docs bigint"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of all rows one after another, and each one's row."""
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = np.flatnonzero(letter & (edge[:-1] | ~np.r_[False, letter[:-1]]))
    last = np.flatnonzero(letter & (edge[1:] | ~np.r_[letter[1:], False]))
    ends = np.r_[0, np.cumsum(last + 1 - first)].astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(_LOWER[data[letter]]))
    return words, np.searchsorted(offsets, first, side="right") - 1


def _chunk_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of some documents: one row per group and term of the chunk."""
    data, offsets = text_column(batch.column(2))
    words, row = _terms(data, offsets)
    encoded = words.dictionary_encode()
    size = max(len(encoded.dictionary), 1)
    in_row, repeats = np.unique(row * size + encoded.indices.to_numpy(), return_counts=True)
    names, group = {}, np.zeros(len(batch), np.int64)
    for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
        group[i] = names.setdefault(key, len(names))
    cell, back, docs = np.unique(group[in_row // size] * size + in_row % size, return_inverse=True, return_counts=True)
    n = np.zeros(len(cell), np.int64)
    np.add.at(n, back, repeats)
    keys = list(names)
    lang, source = (pa.array([k[i] for k in keys], pa.string()).take(pa.array(cell // size, pa.int64())) for i in (0, 1))
    term = encoded.dictionary.take(pa.array(cell % size, pa.int64())).cast(pa.string())
    return pa.RecordBatch.from_arrays([lang, source, term, pa.array(n), pa.array(docs.astype(np.int64))], ["lang", "source", "term", "n", "docs"])


@releasing
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, offsets = text_column(batch.column(2))
        for a, b in row_chunks(offsets, 1 << 22):
            yield _chunk_counts(batch.slice(a, b - a))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group.

    A chunk of documents is counted in its task, tasks are added up before the exchange, so a frequent term or a hot source sends a row a task.
    """
    empty = F.lit("")
    rows = docs.select(*(F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")))
    return rows.mapInArrow(_count, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, total, first): the counts of kept terms in the group and in the language; `first` is 1 in one row of each kept term.

    A window over (lang, term) holds a row per source.
    """
    term = Window.partitionBy("lang", "term")
    counted = term_counts(docs).withColumns({"total": F.sum("n").over(term), "_docs": F.sum("docs").over(term), "_first": F.min("source").over(term)})
    return counted.where(F.col("_docs") >= least_docs).select("lang", "source", "term", "n", "total", (F.col("source") == F.col("_first")).cast("long").alias("first"))


def _share(count: str, size: str, terms: str = "kept") -> Column:
    """1 + floor(SCALE (count + 1) / (size + terms)), exact for counts of any size."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) div cast({size} + {terms} as decimal(20,0))")


def _divergence(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so their product fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, size, held, kept, lang_size) of every group that occurs: occurrences of kept terms and how many different ones it holds; how many its language keeps, and their occurrences."""
    empty = F.lit("")
    occurring = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("held"), F.sum("first").alias("_first"))
    all_groups = occurring.join(sums, ["lang", "source"], "left").fillna(0, ["size", "held", "_first"])
    lang = Window.partitionBy("lang")  # a row per source
    return all_groups.withColumns({"kept": F.sum("_first").over(lang), "lang_size": F.sum("size").over(lang)}).drop("_first")


def top_terms(kept: DataFrame, sizes: DataFrame, base: str, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group has more of than its language, those of the first `top` ranks.

    At most `top` values per group reach the cumulative window, whatever the number of cells; the chosen cells are written, so that their size
    is known when Spark decides how to join them with the terms.
    """
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "total").agg(F.count("*").alias("many")).join(sizes, group)
    cells = cells.withColumns({"p": _share("n", "size"), "q": _share("total", "lang_size")}).where("p > q").withColumn("value", _divergence("p", "q"))
    cells = cells.select(*group, "n", "total", "many", "value")
    values = cells.groupBy(*group, "value").agg(F.sum("many").alias("many"))
    by_value = Window.partitionBy(*group).orderBy(F.desc("value"))
    values = values.withColumn("_k", F.row_number().over(by_value)).where(F.col("_k") <= top)
    before = F.coalesce(F.sum("many").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", before).where(F.col("before") < top).select(*group, "value", "before")
    cells.join(values, [*group, "value"]).select(*group, "n", "total", "value", "before").write.parquet(f"{base}/cells")
    chosen = kept.sparkSession.read.parquet(f"{base}/cells")
    terms = kept.select(*group, "term", "n", "total").join(chosen, [*group, "n", "total"])
    place = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    ranked = terms.withColumn("_place", place).where(F.col("_place") <= top).withColumn("rank", F.col("before") + F.col("_place")).where(F.col("rank") <= top)
    return ranked.select(*group, F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank"))


def source_pairs(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of a group's language by the sum of f over the kept terms.

    The result has a row for each ordered pair of a language's sources, as it is asked for; terms meet only where both sources hold them, and are
    counted in cells of equal counts before the exchange.
    """
    pair = ["lang", "source", "item"]
    side = lambda source, count: kept.select("lang", "term", F.col("source").alias(source), F.col("n").alias(count))
    shared = side("a", "c").join(side("b", "d"), ["lang", "term"]).where("a < b").groupBy("lang", "a", "b", "c", "d").agg(F.count("*").alias("many"))

    def cell(source, item, c, d, many) -> Column:
        value = lambda x: F.lit(x).cast("long") if isinstance(x, int) else F.col(x)
        return F.struct(F.col(source).alias("source"), F.col(item).alias("item"), value(c).alias("c"), value(d).alias("d"), many.alias("many"))

    many = F.col("many")
    # a term of both sources is no term of one alone: it leaves the two cells that the histograms put it in, and comes back to (0, 0), which they took it from twice
    both = [x for s, t, c, d in (("a", "b", "c", "d"), ("b", "a", "d", "c")) for x in (cell(s, t, c, d, many), cell(s, t, c, 0, -many), cell(s, t, 0, d, -many), cell(s, t, 0, 0, many))]
    cells = shared.select("lang", F.explode(F.array(*both)).alias("x")).select("lang", "x.*")
    other = sizes.select("lang", F.col("source").alias("item"), F.col("size").alias("other_size"), F.col("held").alias("other_held"))
    pairs = sizes.join(other, "lang").where("source <> item").select(*pair, "size", "other_size", "kept", "held", "other_held")
    counts = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("many"))
    zero = F.lit(0).cast("long")
    one_side = pairs.select(*pair).join(counts, ["lang", "source"]).select(*pair, F.col("n").alias("c"), zero.alias("d"), "many")
    other_side = pairs.select(*pair).join(counts.withColumnRenamed("source", "item"), ["lang", "item"]).select(*pair, zero.alias("c"), F.col("n").alias("d"), "many")
    neither = pairs.select(*pair, zero.alias("c"), zero.alias("d"), F.expr("kept - held - other_held").alias("many"))
    cells = cells.unionByName(one_side).unionByName(other_side).unionByName(neither).groupBy(*pair, "c", "d").agg(F.sum("many").alias("many")).where("many <> 0")
    valued = cells.join(pairs.where("kept > 0"), pair).withColumns({"p": _share("c", "size"), "q": _share("d", "other_size")})
    sums = valued.withColumn("f", _divergence("p", "q")).groupBy(*pair).agg(F.sum(F.expr("cast(many as decimal(19,0)) * cast(f as decimal(19,0))")).cast("long").alias("value"))
    ranked = pairs.select(*pair).join(sums, pair, "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return ranked.select(*pair, "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group: part "pair" the language's other sources, part "term" the terms it has more of than its language.

    `docs` has text, lang and source; other columns play no part.  Repeated rows count each.  Ties go by the item's UTF-8 bytes.  A group without terms has
    pairs but no terms; where a language keeps no term, pairs have the value 0.  Without documents there are no rows.  The counts of kept terms and
    the chosen cells are written to the shared folder, so that a lost executor costs no second count.
    """
    spark = docs.sparkSession
    base = f"{shared_folder(spark)}/divergence-{uuid.uuid4().hex}"
    kept_terms(docs, least_docs).write.parquet(f"{base}/kept")
    kept = spark.read.parquet(f"{base}/kept")
    group_sizes(docs, kept).write.parquet(f"{base}/sizes")
    sizes = spark.read.parquet(f"{base}/sizes")
    parts = {"pair": source_pairs(kept, sizes), "term": top_terms(kept, sizes, base, top)}
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair, term = (df.withColumn("part", F.lit(name)).select(*columns) for name, df in parts.items())
    return pair.unionByName(term)

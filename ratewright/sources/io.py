"""Readers, writers, fingerprints and snapshots."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between steps: what spark.checkpoint.dir names or the context has.

    Where neither is set, one in the warehouse, on a local master only: on a cluster the default warehouse may be each machine's own disk, so that raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_between"
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """`df.checkpoint()` in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder: it is made once, outlives its executors, and Spark knows its size."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip().lower() for c in df.columns))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any Hadoop file system is there."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def read_typed(spark: SparkSession, path: str, schema: StructType, format: str = "parquet") -> DataFrame:
    """A table with lower-case trimmed column names; an empty one where the path is not there."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if format in ("csv", "json") else spark.read
    if format == "csv":
        reader = reader.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    return _clean_names(reader.format(format).load(path))


def first_available(candidates: dict[str, DataFrame | None], column: str = "source") -> DataFrame:
    """The first candidate that has a row, with its name; the last one if none has."""
    given = {k: v for k, v in candidates.items() if v is not None}
    for name, df in given.items():
        if not df.isEmpty():
            return df.withColumn(column, F.lit(name))
    name, df = list(given.items())[-1]
    return df.withColumn(column, F.lit(name))


OFFERS = "array<struct<id:string,commence_time:string,home_team:string,away_team:string,bookmakers:array<struct<key:string,last_update:string,markets:array<struct<key:string,outcomes:array<struct<name:string,price:double,point:double>>>>>>>>"


def read_nested_offers(documents: DataFrame, column: str, market: str = "spreads") -> DataFrame:
    """One row per event and book of a JSON feed with both sides' points; pairs that are missing or not opposite are left out."""
    event = documents.select(F.explode(F.from_json(column, OFFERS)).alias("e")).select("e.*")
    book = event.select("id", "home_team", "away_team", F.explode("bookmakers").alias("b"))
    rows = book.select("id", "home_team", "away_team", F.col("b.key").alias("book"), F.to_timestamp("b.last_update").alias("updated"), F.explode("b.markets").alias("m")).where(F.col("m.key") == market)
    point = lambda team: F.try_element_at(F.filter("m.outcomes", lambda o: o["name"] == F.col(team)), F.lit(1))
    out = rows.withColumns({"h": point("home_team"), "a": point("away_team")}).select("id", "book", "updated", "home_team", "away_team", F.col("h.point").alias("home_point"), F.col("a.point").alias("away_point"), F.col("h.price").alias("home_price"))
    return out.where("home_point is not null and away_point is not null and not isnan(home_point) and home_point = -away_point").withColumn("home_margin", -F.col("home_point"))


DEPTH = "struct<depthchart:array<struct<positions:map<string,struct<athletes:array<struct<id:string,displayName:string>>>>>>>"


def read_nested_depth(documents: DataFrame, team: str, column: str) -> DataFrame:
    """(team, position, rank, athlete) of a JSON depth feed of position maps and ordered athletes."""
    chart = documents.select(team, F.explode(F.from_json(column, DEPTH)["depthchart"]).alias("c"))
    slots = chart.select(team, F.explode("c.positions").alias("position", "p"))
    return slots.select(team, "position", F.posexplode("p.athletes").alias("_at", "x")).select(team, "position", (F.col("_at") + 1).alias("rank"), F.col("x.id").alias("athlete_id"), F.col("x.displayName").alias("athlete"))


def union_seasons(tables: dict[int, DataFrame], key: list[str], weights: dict[int, float]) -> DataFrame:
    """Seasonal exports with their season and weight; a repeated (season, key) raises when the plan runs."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumns({"season": F.lit(s), "season_weight": F.lit(weights.get(s, 0.0))}) for s, df in tables.items()])
    from pyspark.sql import Window

    n = F.count("*").over(Window.partitionBy("season", *key))
    return rows.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(F.lit("repeated key in a season")).cast("boolean")).otherwise(True)).drop("_n")


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions that `df` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_evolving(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """History whose later files may have more columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def persist_with_history(df: DataFrame, base: str, run_id: str, csv: bool = False) -> None:
    """The same rows as the current table, appended to the history, counted in a run audit, and as CSV."""
    stamped = df.withColumn("run_id", F.lit(run_id)).persist()
    try:
        stamped.write.mode("overwrite").parquet(f"{base}/current")
        stamped.write.mode("append").parquet(f"{base}/history")
        stamped.agg(F.count("*").alias("rows")).withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(f"{base}/audit")
        if csv:
            stamped.write.mode("overwrite").option("header", True).csv(f"{base}/csv")
    finally:
        stamped.unpersist()


def _row_hash(columns: list[str], digits: int):
    return lambda df: [F.round(F.col(c), digits).alias(c) if dict(df.dtypes)[c] in ("double", "float") else F.col(c) for c in columns]


def frame_fingerprint(df: DataFrame, columns: list[str], digits: int = 9) -> DataFrame:
    """(rows, xor, total): a hash of the chosen columns that doesn't depend on row order; repeated rows count."""
    h = F.xxhash64(*_row_hash(columns, digits)(df))
    return df.select(h.alias("h")).agg(F.count("*").alias("rows"), F.bit_xor("h").alias("xor"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("total"))


def row_lineage(df: DataFrame, columns: list[str], out: str = "row_hash") -> DataFrame:
    """SHA-256 of the row's fields as JSON, in the order of their names."""
    return df.withColumn(out, F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256))


def immutable_snapshot(df: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Write once.  Later calls return what was written and raise if its stored fingerprint no longer fits it."""
    spark = df.sparkSession
    if not exists(spark, path):
        df.write.parquet(f"{path}/rows")
        frame_fingerprint(spark.read.parquet(f"{path}/rows"), columns).write.parquet(f"{path}/fingerprint")
    kept = spark.read.parquet(f"{path}/rows")
    if frame_fingerprint(kept, columns).first() != spark.read.parquet(f"{path}/fingerprint").first():
        raise ValueError(f"the snapshot {path} was changed")
    return kept


def drift(snapshot: DataFrame, current: DataFrame, key: list[str], value: str) -> DataFrame:
    return snapshot.select(*key, F.col(value).alias("frozen")).join(current.select(*key, F.col(value).alias("current")), key, "full_outer").withColumn("drift", F.col("current") - F.col("frozen"))


def season_context(events: DataFrame, targets: DataFrame, season: str, back: int = 4) -> DataFrame:
    """For each target season the rows of the `back` seasons before it, with target_season: an equi join on a generated season list."""
    wanted = targets.select(F.col(season).alias("target_season"), F.explode(F.sequence(F.col(season) - back, F.col(season) - 1)).alias(season))
    return events.join(F.broadcast(wanted), season)  # seasons squared at most

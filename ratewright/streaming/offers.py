"""Arriving offers: the best current one per game, from keyed state with event-time timers, in a table that changes batch by batch or not at all.

State holds the newest offer of each book of a game, so it is bounded by games times books and not by arrivals; games are kept in buckets.  When the watermark passes the
age at which the chosen offer goes stale, a timer chooses anew, whether the game gets offers or not.  What changes is appended to a table as a
delta of its batch; a commit file, put in place by one rename, makes it visible.  A batch that is played again finds its commit or
overwrites its unfinished delta; a batch whose predecessor isn't committed raises.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def live_offers(stream: DataFrame, ts: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Offers without repeats inside the watermark; later ones than the watermark are dropped."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB store: call this before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class _BestOffers(StatefulProcessor):
    """State of a bucket of games, in one value: for each the newest offer of each book, the offer last said to be best and when it goes stale; and the timer set.

    A bucket is read, written and timed as one, since each call of the state costs far more than the choice for a game.
    """

    def __init__(self, schema: T.StructType, priority: list[str], most_minutes: float, tie: list[str]):
        self.schema, self.tie = schema, tie
        self.place = {b: i for i, b in enumerate(priority)}
        self.most = int(most_minutes * 60_000)
        self.fields = [f for f in schema.fields if f.name not in ("game", "reason")]
        self.names = [f.name for f in self.fields]

    def init(self, handle) -> None:
        self.handle = handle
        offers = T.ArrayType(T.StructType(self.fields))
        game = T.StructType([self.schema["game"], T.StructField("books", offers), T.StructField("said", offers), T.StructField("due", T.LongType())])
        self.state = handle.getValueState("bucket", T.StructType([T.StructField("games", T.ArrayType(game)), T.StructField("timer", T.LongType())]))

    def _order(self, offer: dict) -> tuple:
        """Later offers are greater: by time, then by the tie-breaks."""
        return offer["us"], *(offer[t] for t in self.tie)

    def _choose(self, arrived: dict, now: int) -> Iterator[Row]:
        """Choose for the games with arrivals ({game: {book: offer}}) and those whose offer went stale."""
        offers = lambda rows: [dict(zip(self.names, r, strict=True)) for r in rows or ()]
        plain = lambda o: tuple(o[c] for c in self.names)
        which = lambda o: (o["book"], self._order(o))
        stale_at = lambda o: o["us"] // 1000 + self.most + 1
        kept, timer = self.state.get() or ((), None)
        bare = lambda rows: None if rows is None else [tuple(r) for r in rows]  # noqa: E731 (the state gives rows, but takes tuples)
        games, changes = {g: (bare(books), bare(said), due) for g, books, said, due in kept or ()}, []
        for g in {**arrived, **{g: None for g, (_, _, due) in games.items() if due is not None and due <= now}}:
            books, said, _ = games.get(g, ((), None, None))
            newest = {o["book"]: o for o in offers(books)}
            for book, offer in arrived.get(g, {}).items():
                if book not in newest or self._order(newest[book]) < self._order(offer):
                    newest[book] = offer
            fresh = [o for o in newest.values() if stale_at(o) > now]  # the others can't be chosen again
            best = max(fresh, key=lambda o: (-self.place.get(o["book"], len(self.place)), self._order(o)), default=None)
            if said is None or [which(o) for o in offers(said)] != ([which(best)] if best else []):
                row = {"game": g} | (best or dict.fromkeys(self.names)) | {"reason": None if best else "no fresh offer"}
                changes.append(Row(**{c: row[c] for c in self.schema.names}))
            games[g] = [plain(o) for o in fresh], [plain(best)] if best else [], stale_at(best) if best else None
        due = min((d for _, _, d in games.values() if d is not None), default=None)
        if due != timer:
            if timer is not None and timer > now:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.state.update(([(g, *x) for g, x in games.items()], due))
        yield from changes

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest, order = {}, []
        for row in rows:
            if not order:
                at = {c: i for i, c in enumerate(row.__fields__)}
                game, book, order = at["game"], at["book"], [at["us"], *(at[t] for t in self.tie)]
            last = newest.get((row[game], row[book]))
            if row[book] is not None and (last is None or [last[i] for i in order] < [row[i] for i in order]):
                newest[row[game], row[book]] = row
        arrived: dict = {}
        for (g, b), row in newest.items():
            arrived.setdefault(g, {})[b] = {c: row[at[c]] for c in self.names}
        if arrived:
            yield from self._choose(arrived, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._choose({}, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def best_offers(stream: DataFrame, game: str, book: str, priority: list[str], ts: str, most_minutes: float, tie: list[str], buckets: int = 512) -> DataFrame:
    """A row whenever the choice of a game changes: the newest offer of the best-placed book that isn't older than `most_minutes` at the watermark, else a reason.

    `stream` has a watermark on `ts`; `tie` orders offers of one time and holds no nulls.  Books outside `priority` share the last place.  Offers
    without a book or a time are left out.  Rows are read one by one, however many a game has.  Games share `buckets` keys of the state, which bounds the calls of a
    batch to it; a running stream keeps the number it began with.
    """
    payload = [f for f in stream.schema.fields if f.name not in (game, book, ts)]
    given = {game: "game", book: "book", ts: "ts"} | {f.name: f"c{i}" for i, f in enumerate(payload)}  # names that a Python tuple may have
    rows = stream.where(F.col(ts).isNotNull()).select(*(F.col(c).alias(given[c]) for c in stream.columns), F.unix_micros(ts).alias("us"))
    fields = [T.StructField("game", stream.schema[game].dataType), T.StructField("book", T.StringType()), *(T.StructField(given[f.name], f.dataType) for f in payload), T.StructField("us", T.LongType())]
    out = T.StructType([*fields, T.StructField("reason", T.StringType())])
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("game"), F.lit(buckets)))
    said = rows.groupBy("bucket").transformWithState(statefulProcessor=_BestOffers(out, priority, most_minutes, [given[t] for t in tie]), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return said.select(*((F.timestamp_micros("us") if c == ts else F.col(given[c])).alias(c) for c in stream.columns), "reason")


class DeltaTable:
    """A keyed table in a shared folder that changes by whole batches.

    `base-N` is the table after batch N, `delta-N` what batch N changes, `commit-N` says which of them are the table.  Every `compact`
    batches a new base is written; what a commit no longer names is removed with the next one, so that a reader of the last table can finish.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, compact: int = 10):
        self.spark, self.path, self.key, self.compact = spark, path.rstrip("/"), key, compact
        self.fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.fs_path(f"{self.path}/{name}")

    def _names(self) -> list[str]:
        root = self.fs_path(self.path)
        return [s.getPath().getName() for s in self.fs.listStatus(root)] if self.fs.exists(root) else []

    def last(self) -> dict | None:
        """The newest commit: {"batch", "base", "deltas"}."""
        batches = [int(n.removeprefix("commit-")) for n in self._names() if n.startswith("commit-")]
        return json.loads(self.spark.read.text(f"{self.path}/commit-{max(batches)}", wholetext=True).first()[0]) if batches else None

    def _put(self, name: str, text: str) -> None:
        """The whole file under its name, or none: it is written beside and renamed."""
        part = self._at(f"_{name}")
        stream = self.fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(part, self._at(name)):
            raise OSError(f"{self.path}/{name} could not be put in place")

    def apply(self, changes: DataFrame, batch: int, after_write: Callable[[], None] = lambda: None) -> None:
        """Commit a batch: rows of `changes` replace those of their keys, the last of a key by `_order` if there is that column.

        Of a committed batch the table is left alone; its rows are still computed, as the stream's state is committed by that.  `after_write` runs between writing and committing, for tests of a failure there.
        """
        last = self.last()
        if last and last["batch"] >= batch:
            changes.write.format("noop").mode("overwrite").save()
            return
        if (last["batch"] if last else -1) != batch - 1:
            raise ValueError(f"batch {batch} of {self.path} comes after {last['batch'] if last else 'none'}: a batch is missing")
        changes.write.mode("overwrite").parquet(f"{self.path}/delta-{batch}")
        now = {"batch": batch, "base": last["base"] if last else None, "deltas": [*(last["deltas"] if last else []), batch]}
        if len(now["deltas"]) >= self.compact:
            self._rows(now).write.mode("overwrite").parquet(f"{self.path}/base-{batch}")
            now |= {"base": batch, "deltas": []}
        after_write()
        self._put(f"commit-{batch}", json.dumps(now))
        self._remove(last, now)

    def _remove(self, last: dict | None, now: dict) -> None:
        """All folders that neither the new commit nor the one before it names."""
        kept = {f"commit-{c['batch']}" for c in (last, now) if c} | {f"base-{c['base']}" for c in (last, now) if c and c["base"] is not None} | {f"delta-{d}" for c in (last, now) if c for d in c["deltas"]}
        for name in self._names():
            if name.split("-")[0] in ("commit", "base", "delta") and name not in kept:
                self.fs.delete(self._at(name), True)

    def _rows(self, commit: dict) -> DataFrame:
        parts = [(-1, f"base-{commit['base']}")] if commit["base"] is not None else []
        parts += [(d, f"delta-{d}") for d in commit["deltas"]]
        frames = [self.spark.read.parquet(f"{self.path}/{name}").withColumn("_batch", F.lit(n)) for n, name in parts]
        rows = frames[0]
        for df in frames[1:]:
            rows = rows.unionByName(df)
        columns = [c for c in rows.columns if c not in (self.key, "_batch")]
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*columns), "_batch").alias("_r"))  # partial: a row per key and task
        return newest.select(self.key, "_r.*")

    def read(self) -> DataFrame:
        """The table after the last committed batch."""
        last = self.last()
        if last is None:
            raise ValueError(f"{self.path} has no committed batch")
        return self._rows(last)


def keep_best(spark: SparkSession, path: str, game: str, compact: int = 10) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function for `best_offers`: each batch's changes are one commit of the table."""

    def write(batch: DataFrame, number: int) -> None:
        DeltaTable(batch.sparkSession, path, game, compact).apply(batch, number)

    return write

"""The offer stream: failures between and inside batches, timers, late and repeated offers, and the table's commits."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratewright.streaming import offers



@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a batch starts Python and state stores anew."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", was)


START = dt.datetime(2024, 3, 1)
SCHEMA = "game long, book string, event_id long, _line double, ts timestamp"
PRIORITY, MOST, LATE = ["a", "b"], 30.0, 5


def offer(game, book, i, minute):
    return game, book, i, float(i), START + dt.timedelta(minutes=minute) if minute is not None else None


def batch_answer(rows):
    """What one pass over all offers gives at the last watermark."""
    now = max(r[4] for r in rows if r[4]) - dt.timedelta(minutes=LATE)
    best = {}
    for g, b, i, line, ts in rows:
        if b is None or ts is None:
            continue
        best.setdefault(g, None)
        if now - ts <= dt.timedelta(minutes=MOST):
            place = PRIORITY.index(b) if b in PRIORITY else len(PRIORITY)
            if best[g] is None or (-place, ts, i) > best[g][0]:
                best[g] = (-place, ts, i), (b, i, line)
    return {g: v[1] if v else (None, None, None) for g, v in best.items()}


class Stream:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        offers.use_state_store(spark)

    def put(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self, write=None, compact=3):
        raw = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/in")
        best = offers.best_offers(offers.live_offers(raw, "ts", ["event_id"], f"{LATE} minutes"), "game", "book", PRIORITY, "ts", MOST, ["event_id"])
        q = best.writeStream.outputMode("append").foreachBatch(write or offers.keep_best(self.spark, f"{self.folder}/best", "game", compact)).option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
        q.awaitTermination()

    @property
    def table(self):
        return offers.DeltaTable(self.spark, f"{self.folder}/best", "game", 3)

    def read(self):
        return {r.game: (r.book, r.event_id, r._line) for r in self.table.read().collect()}


def arrivals(seed, n=120):
    """Slices in the order of time, with repeats and offers of no book or time."""
    rng = random.Random(seed)
    out = []
    for part in range(3):
        rows = [offer(rng.randint(1, 9), rng.choice(["a", "b", "b", "y", "z", None]), part * 1000 + i, part * 25 + rng.randint(0, 24)) for i in range(n // 3)]
        out.append([*rows, rows[0], rows[1], offer(50, "a", part * 1000 + 999, None)])
    return out


def test_equals_the_batch_answer_over_restarts(spark, tmp_path):
    s, seen = Stream(spark, str(tmp_path)), []
    for part in arrivals(1):
        s.put(part)
        seen += part
        s.run()
        assert s.read() == batch_answer(seen)


def test_a_timer_retires_an_offer_of_a_silent_game(spark, tmp_path):
    s = Stream(spark, str(tmp_path))
    s.put([offer(1, "a", 1, 0), offer(1, "b", 2, 20), offer(2, "a", 3, 0)])
    s.run()
    assert s.read() == {1: ("a", 1, 1.0), 2: ("a", 3, 3.0)}
    s.put([offer(3, "b", 4, 50)])
    s.run()
    assert s.read() == {1: ("b", 2, 2.0), 2: (None, None, None), 3: ("b", 4, 4.0)}
    assert {r.game: r.reason for r in s.table.read().collect()} == {1: None, 2: "no fresh offer", 3: None}


def test_later_than_the_watermark_is_dropped(spark, tmp_path):
    s = Stream(spark, str(tmp_path))
    s.put([offer(1, "b", 1, 60)])
    s.run()
    s.put([offer(1, "a", 2, 40), offer(1, "a", 3, 58)])
    s.run()
    assert s.read() == {1: ("a", 3, 3.0)}


@pytest.mark.parametrize("where", ["before", "inside", "after"])
def test_a_batch_that_dies_is_played_again(spark, tmp_path, where):
    """Dies before its delta is written, between delta and commit, or after the commit but before the stream knows."""
    s, parts = Stream(spark, str(tmp_path)), arrivals(2)
    s.put(parts[0])
    s.run()
    before = s.read()
    s.put(parts[1])

    def die():
        raise RuntimeError("killed")

    def write(batch, number):
        if where == "before":
            die()
        s.table.apply(batch, number, die if where == "inside" else lambda: None)
        die()

    with pytest.raises(Exception, match="killed"):
        s.run(write)
    if where != "after":
        assert s.read() == before  # nothing half-done is seen
    s.run()
    assert s.read() == batch_answer(parts[0] + parts[1])
    s.put(parts[2])
    s.run()
    assert s.read() == batch_answer(sum(parts, []))


def changes(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def test_a_missing_batch_raises(spark, tmp_path):
    t = offers.DeltaTable(spark, str(tmp_path / "t"), "k")
    with pytest.raises(ValueError, match="missing"):
        t.apply(changes(spark, [(1, "x")]), 1)
    t.apply(changes(spark, [(1, "x")]), 0)
    with pytest.raises(ValueError, match="missing"):
        t.apply(changes(spark, [(1, "y")]), 2)
    t.apply(changes(spark, [(1, "z")]), 0)  # played again: already there
    assert [r.v for r in t.read().collect()] == ["x"]
    with pytest.raises(ValueError, match="no committed"):
        offers.DeltaTable(spark, str(tmp_path / "u"), "k").read()


def test_compaction_keeps_rows_and_removes_folders(spark, tmp_path):
    t, want = offers.DeltaTable(spark, str(tmp_path / "t"), "k", compact=3), {}
    for n in range(11):
        rows = [(k, f"{n}.{k}") for k in range(n % 4, n % 4 + 3)]
        t.apply(changes(spark, rows), n)
        want |= dict(rows)
        assert {r.k: r.v for r in t.read().collect()} == want
    names = {p.name for p in Path(tmp_path / "t").iterdir() if not p.name.startswith(("_", "."))}
    assert "commit-10" in names and len([n for n in names if n.startswith("commit-")]) == 2
    assert len([n for n in names if n.startswith("base-")]) == 1 and len([n for n in names if n.startswith("delta-")]) <= 3


def test_other_columns_keep_their_names_and_times(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        s = Stream(spark, str(tmp_path))
        s.put([offer(1, "a", 1, 3)])
        s.run()
        row = s.table.read().select("ts", F.unix_micros("ts").alias("us"), "_line").first()
        assert row.us == spark.createDataFrame([offer(1, "a", 1, 3)], SCHEMA).select(F.unix_micros("ts")).first()[0] and row._line == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_games_share_buckets_of_the_state(spark, tmp_path):
    """Calls of the state follow the buckets, not the games; a timer of one game leaves its neighbours alone."""
    s = Stream(spark, str(tmp_path))
    s.put([offer(g, "a", g, g % 2 * 20) for g in range(60)] + [offer(99, "b", 99, 50)])
    raw = spark.readStream.schema(SCHEMA).parquet(f"{s.folder}/in")
    best = offers.best_offers(offers.live_offers(raw, "ts", ["event_id"], f"{LATE} minutes"), "game", "book", PRIORITY, "ts", MOST, ["event_id"], buckets=3)
    q = best.writeStream.outputMode("append").foreachBatch(offers.keep_best(spark, f"{s.folder}/best", "game")).option("checkpointLocation", f"{s.folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    want = {g: ("a", g, float(g)) if g % 2 else (None, None, None) for g in range(60)} | {99: ("b", 99, 99.0)}
    assert s.read() == want
    kept = spark.read.format("statestore").option("path", f"{s.folder}/state").option("operatorId", 0).option("stateVarName", "bucket").load()
    assert kept.count() <= 3

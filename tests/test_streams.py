"""Streams of more than one batch: replays, crashes, late rows, closing weeks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from signalloom.operators import state as ST
from signalloom.sources.tables import Snapshots
from signalloom.streaming import ingest as I, velocity as SV
from signalloom.streaming.history import into_history

SCHEMA = ("name string, first_seen string, last_seen string, times_seen long, is_new int, notified int, gtm_score long")


def writer(spark, store):
    def merge(history, batch, batch_id):
        return ST.upsert(history, batch, ST.name_key("name"), ST.name_key("company"), {}, {"company": "name"},
                         F.lit(f"day {batch_id}"), best="gtm_score").drop("new_this_run")
    return into_history(store, "history", SCHEMA, merge, ST.name_key("company"), ST.name_key("name"), 8)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "company string, gtm_score long")


def rows(store):
    return {r.name: (r.times_seen, r.gtm_score, r.last_seen)
            for r in store.read("history", store.version(), SCHEMA).collect()}


def test_each_batch_counts_once(spark, tmp_path, monkeypatch):
    store = Snapshots(spark, str(tmp_path))
    write = writer(spark, store)
    write(batch(spark, ("A", 3), ("B", 1)), 0)
    write(batch(spark, ("A", 2), ("C", 5)), 1)
    want = {"A": (2, 3, "day 1"), "B": (1, 1, "day 0"), "C": (1, 5, "day 1")}
    assert rows(store) == want and store.version() == 2
    # the stream died after the commit and before it noted the batch: the batch comes again
    write(batch(spark, ("A", 2), ("C", 5)), 1)
    writer(spark, Snapshots(spark, str(tmp_path)))(batch(spark, ("A", 2), ("C", 5)), 1)
    write(batch(spark, ("A", 3), ("B", 1)), 0)
    write(batch(spark), 2)
    assert rows(store) == want and store.version() == 2
    # it died between writing and committing: nothing of it counts until it comes again
    with monkeypatch.context() as m:
        m.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(IOError()))
        with pytest.raises(IOError):
            write(batch(spark, ("B", 9)), 3)
    assert rows(store) == want
    write(batch(spark, ("B", 9)), 3)
    assert rows(store) == want | {"B": (2, 9, "day 3")}


def land(spark, folder, *files):
    for rows_ in files:
        spark.createDataFrame(rows_, "user string, at timestamp").coalesce(1).write.mode("append").parquet(folder)
    return I.read_stream(spark, folder, "user string, at timestamp", files_per_trigger=1)


def test_weeks_close_in_order_with_late_rows(spark, tmp_path):
    rng, start = random.Random(4), dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    files = [[] for _ in range(7)]
    want = {}
    for _ in range(400):
        week, user = rng.randrange(5), rng.choice(["a", "b", "c", "d"])
        if (user, week) in (("c", 1), ("c", 2), ("d", 4)):
            continue  # weeks without a row are passed over
        late = rng.random() < 0.2
        at = start + dt.timedelta(weeks=week, seconds=rng.randrange(7 * 86400))
        files[week + late].append((user, at))
        want[user, week] = want.get((user, week), 0) + 1
    files[5].append(("a", start + dt.timedelta(days=1)))  # five weeks late: the week was closed
    files[6] = [(None, start + dt.timedelta(weeks=9))]
    stream = land(spark, str(tmp_path / "in"), *[f for f in files if f])
    with SV.timers(spark):
        I.run_available(SV.closed_weeks(stream, "user", "at", "8 days"), I.to_batches(str(tmp_path / "out")),
                        str(tmp_path / "state"))
    got = {(r.company_name, (r.week_start - start.date()).days // 7): r
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {k: r.signal_count for k, r in got.items()} == want
    for (user, week), r in got.items():
        before = max((w for u, w in want if u == user and w < week), default=None)
        assert (r.prev_count, r.delta) == ((None, None) if before is None else (
            want[user, before], want[user, week] - want[user, before]))
    assert not spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")


def test_state_does_not_grow_a_row_per_company(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    names = [f"c{k}" for k in range(300)]
    files = [[(c, start + dt.timedelta(weeks=w, minutes=k)) for k, c in enumerate(names) for _ in range(1 + w * (k % 3))]
             for w in range(2)]
    files[1] += [("late", start + dt.timedelta(days=6)), ("c0", start + dt.timedelta(days=6))]
    stream = land(spark, str(tmp_path / "in"), *files, [(None, start + dt.timedelta(weeks=9))])
    with SV.timers(spark):
        query = I.run_available(SV.closed_weeks(stream, "user", "at", "8 days", buckets=4),
                                I.to_batches(str(tmp_path / "out")), str(tmp_path / "state"))
    got = {(r.company_name, (r.week_start - start.date()).days // 7): r
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 601 and got["late", 0].signal_count == 1 and got["c0", 0].signal_count == 2
    for k, c in enumerate(names):
        first, then = (2 if k == 0 else 1), 1 + k % 3
        assert (got[c, 0].signal_count, got[c, 0].prev_count, got[c, 0].delta) == (first, None, None)
        assert (got[c, 1].signal_count, got[c, 1].prev_count, got[c, 1].delta) == (then, first, then - first)
        assert got[c, 1].prev_week == start.date() and got[c, 0].prev_week is None
    rows = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert rows and max(rows) <= 40

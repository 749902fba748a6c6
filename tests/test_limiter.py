"""The stateful rate limit over micro-batches of early, late and tied arrivals, against a plain loop."""

import random
from collections import deque
from datetime import datetime, timedelta

import pandas as pd
from milemark.streaming.ingest import finish
from milemark.streaming.limiter import DECIDED, Instants, RateLimiter, write_limited
from milemark.streaming.windows import count_late

START = datetime(2024, 5, 1)
SCHEMA = "driver_id string, event_at timestamp, arrival_no long"


def plain(rows, limit, window):
    held, out = {}, {}
    for driver, at, number in sorted(rows, key=lambda r: (r[1], r[2])):
        recent = held.setdefault(driver, deque())
        while recent and recent[0] < at - window:
            recent.popleft()
        out[number] = len(recent) < limit
        if out[number]:
            recent.append(at)
    return out


def test_verdicts_do_not_depend_on_the_batches(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), rng.randrange(60_000), i) for i in range(600)]
    rows += [("flood", 30_000 + i // 5, 1000 + i) for i in range(100)]
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def run(batch):
        data = [(d, START + timedelta(milliseconds=t), n) for d, t, n in batch]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        query = write_limited(stream, out, f"{tmp_path}/c", limit=4, window_ms=1000, delay="30 seconds")
        finish(query)
        finish(count_late(stream, Instants(), f"{tmp_path}/counts", f"{tmp_path}/c2", "30 seconds"))
        found = spark.read.schema(DECIDED).parquet(out).collect()
        assert len(found) == len({r.number for r in found})
        return {r.number: r.accepted for r in found}, query.lastProgress

    # rows come up to 25 seconds out of order, less than the delay
    rng.shuffle(rows)
    rows.sort(key=lambda r: (r[1] + 5000 * (r[2] % 4)) // 10_000)
    third = len(rows) // 3
    first, _ = run(rows[:third])
    second, _ = run(rows[third : 2 * third])
    assert first.items() <= second.items()
    run(rows[2 * third :])
    # a row far ahead: all others are decided, and no driver but its own has state; one row behind the watermark
    found, _ = run([("late", 120_000, 5000)])
    assert found == plain(rows, 4, 1000) and False in found.values()
    found, progress = run([("a", 50, 5001), (None, 60, 5002), ("late", 300_000, 5003)])
    assert found == {**plain(rows, 4, 1000), 5000: True}
    counts = spark.read.parquet(f"{tmp_path}/counts/late").collect()
    assert [(r.driver_id, r.n_late) for r in counts] == [("a", 1)]
    # silent drivers have left the state: it holds the one arrival ahead of the watermark
    assert progress["stateOperators"][0]["numRowsTotal"] == 1


def decide(spark, base, batches, **settings):
    """Verdicts and the most rows that the state held, of micro-batches that come one by one."""
    for batch in batches:
        data = [(d, START + timedelta(milliseconds=t), n) for d, t, n in batch]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        query = write_limited(stream, f"{base}/out", f"{base}/c", **settings)
        finish(query)
    most = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    return spark.read.schema(DECIDED).parquet(f"{base}/out").collect(), most


def test_state_and_calls_do_not_grow_with_the_drivers(spark, tmp_path):
    rows = [(f"d{i}", i % 1000, i) for i in range(9000)]
    found, most = decide(spark, tmp_path, [rows], limit=1, window_ms=1000, delay="30 seconds")
    # every driver waits in the state, none has rows of its own in it
    assert found == [] and 0 < most <= 4096


def test_drivers_of_one_bucket_are_decided_apart(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"d{rng.randrange(40)}", rng.randrange(60_000), i) for i in range(3000)]
    rows.sort(key=lambda r: (r[1] + 5000 * (r[2] % 4)) // 10_000)
    settings = {"limit": 2, "window_ms": 1500, "delay": "30 seconds", "buckets": 3}
    found, most = decide(spark, tmp_path, [rows[:1000], rows[1000:], [("end", 200_000, 9000)]], **settings)
    expected = plain(rows, 2, 1500)
    assert {r.number: r.accepted for r in found} == expected and len(found) == len(expected)
    assert {r.number: r.driver_id for r in found} == {n: d for d, _, n in rows}
    assert 0 < sum(expected.values()) < 3000


def test_arrivals_without_a_number_come_last_and_leave_others_theirs(spark, tmp_path):
    large = 2**60 + 1
    rows = [("a", 10, None), ("a", 10, large), ("a", 10, None), ("b", 20, large + 1)]
    found, _ = decide(spark, tmp_path, [rows, [("end", 200_000, 0)]], limit=2, window_ms=1000, delay="30 seconds")
    got = sorted((r.driver_id, r.number or 0, r.number is None, r.accepted) for r in found)
    assert got == [("a", 0, True, False), ("a", 0, True, True), ("a", large, False, True), ("b", large + 1, False, True)]


class Kept(list):
    """A list state in memory."""

    get = list.copy
    appendValue = list.append


class Handle:
    """The handle of one bucket, in memory."""

    def __init__(self):
        self.timers, self.states = set(), {}
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getListState(self, name, schema):
        return self.states.setdefault(name, Kept())

    def listTimers(self):
        return iter(self.timers)


class Watermark:
    def __init__(self, at):
        self.getCurrentWatermarkInMs = lambda: at


def test_a_bucket_keeps_tables_of_bounded_length_and_one_timer():
    rng = random.Random(8)
    rows = [(rng.choice("abc"), rng.randrange(5000), i) for i in range(1000)]
    handle, limiter, found, lengths = Handle(), RateLimiter(4, 100, chunk=64), {}, []
    limiter.init(handle)

    def take(batch):
        frame = pd.DataFrame(batch, columns=["driver_id", "at_ms", "number"]).assign(unnumbered=False)
        assert list(limiter.handleInputRows((0,), iter([frame[:200], frame[200:]]), None)) == []
        assert len(handle.timers) == 1

    def wake(watermark):
        (at,) = handle.timers
        for frame in limiter.handleExpiredTimer((0,), Watermark(watermark), None):
            lengths.append(len(frame))
            found.update(zip(frame["number"], frame["accepted"]))
        handle.timers.discard(at)

    take([r for r in rows if r[1] >= 1000][::2])
    take([r for r in rows if r[1] < 1000])
    assert handle.timers == {min(at for _, at, _ in rows)}
    take([r for r in rows if r[1] >= 1000][1::2])
    wake(2500)
    assert found.keys() == {n for _, at, n in rows if at <= 2500}
    assert len(handle.states["pending"]) == -(-sum(at > 2500 for _, at, _ in rows) // 64)
    assert handle.timers == {min(at for _, at, _ in rows if at > 2500)}
    wake(4950)
    assert found.keys() == {n for _, at, n in rows if at <= 4950}
    wake(5050)
    assert found == plain(rows, 4, 100) and max(lengths) <= 64
    assert not handle.states["pending"] and handle.states["accepted"]
    wake(5200)
    # silence: neither state nor timer is left
    assert not handle.states["pending"] and not handle.states["accepted"] and not handle.timers

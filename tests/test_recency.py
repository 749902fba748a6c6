"""Bounded idempotency against a cache that forgets its least recently seen id."""

import random
from collections import OrderedDict

import numpy as np
import pytest

from milemark.operators import recency


def cached(ids, capacity, held=()):
    """Duplicate or not, id by id; and what the cache holds at the end."""
    cache, out = OrderedDict.fromkeys(held), []
    for i in ids:
        if i is None:
            out.append(False)
            continue
        out.append(i in cache)
        cache[i] = None
        cache.move_to_end(i)
        if len(cache) > capacity:
            cache.popitem(last=False)
    return out, list(cache)


def draw(rng, n, pool, hot=0.3):
    return ["hot" if rng.random() < hot else None if rng.random() < 0.03 else f"id{rng.randrange(pool)}" for _ in range(n)]


def frame(spark, ids):
    rows = [(i, i // 3, x) for i, x in enumerate(ids)]
    return spark.createDataFrame(rows, "arrival_no long, arrival_ms long, event_id string").repartition(5)


def marks(df):
    return [r.is_duplicate for r in df.orderBy("arrival_no").collect()]


def test_earlier_greater_equals_counting():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 64, 201):
        v = rng.integers(-1, 40, n)
        assert recency.earlier_greater(v).tolist() == [int((v[:i] > v[i]).sum()) for i in range(n)]


@pytest.mark.parametrize("capacity", [1, 2, 30])
def test_reuse_distance_equals_a_cache(capacity):
    rng = random.Random(capacity)
    for pool in (3, 40, 200):
        ids = [rng.randrange(pool) for _ in range(500)]
        assert recency.repeats(np.array(ids), capacity).tolist() == cached(ids, capacity)[0]


@pytest.mark.parametrize("slice_rows", [20, 64, 100_000])
def test_slices_equal_a_cache(spark, slice_rows):
    rng = random.Random(slice_rows)
    ids = draw(rng, 900, 120)
    ids[300:520] = ["hot"] * 220  # slices with a single id: what came before must reach over them
    for capacity in (1, 25, 90, 5000):
        marked = recency.mark_repeats(frame(spark, ids), ["arrival_ms", "arrival_no"], capacity=capacity, slice_rows=slice_rows)
        assert marked.columns == ["arrival_no", "arrival_ms", "event_id", "is_duplicate"]
        assert marks(marked) == cached(ids, capacity)[0]


def test_cache_carries_over(spark):
    rng = random.Random(4)
    first, second = draw(rng, 400, 90), draw(rng, 300, 90)
    order = ["arrival_ms", "arrival_no"]
    held = cached(first, 40)[1]
    cache = recency.remember(frame(spark, first), order, capacity=40)
    assert [r.event_id for r in cache.orderBy("turn").collect()] == held
    marked = recency.mark_repeats(frame(spark, second), order, capacity=40, cache=cache, slice_rows=50)
    assert marks(marked) == cached(second, 40, held)[0]
    later = recency.remember(frame(spark, second), order, capacity=40, cache=cache)
    assert [r.event_id for r in later.orderBy("turn").collect()] == cached(second, 40, held)[1]


def test_odd_arrivals(spark):
    order = ["arrival_ms", "arrival_no"]
    assert recency.mark_repeats(frame(spark, ["a"]).limit(0), order).collect() == []
    assert marks(recency.mark_repeats(frame(spark, [None, None, "a", "a"]), order)) == [False, False, False, True]
    with pytest.raises(ValueError):
        recency.mark_repeats(frame(spark, ["a"]), order, capacity=0)


def test_few_ids_make_no_small_slices(spark):
    """However few ids are remembered, slices hold many arrivals."""
    ids = draw(random.Random(4), 3000, 40)
    kept = {}

    def keep(df, name):
        kept[name] = df.localCheckpoint()
        return kept[name]

    assert marks(recency.mark_repeats(frame(spark, ids), ["arrival_ms", "arrival_no"], capacity=3, keep=keep)) == cached(ids, 3)[0]
    assert kept["sliced"].select("_slice").distinct().count() == 1

"""Window rollups from change points against plain Python over dense samples."""

import random

import bson_build as b
import pytest

from diagarc.operators.decode import decode_chunks, value_changes
from diagarc.operators.rollup import MOST_MS, rollup, window_parts


def chunks(spark, bodies, **options):
    rows = [("p", i, bytearray(x)) for i, x in enumerate(bodies)]
    return decode_chunks(spark.createDataFrame(rows, "path string, doc_no bigint, body binary"), **options)


def body(times, **metrics):
    """One chunk of the given samples; the axis comes first."""
    columns = [times, *metrics.values()]
    reference = {n: b.int64(c[0]) for n, c in zip(["start", *metrics], columns)}
    deltas = [y - x for c in columns for x, y in zip(c, c[1:])]
    tokens, zeros = [], 0
    for delta in [*deltas, None]:
        if delta == 0:
            zeros += 1
            continue
        tokens += [0, zeros - 1] if zeros else []
        tokens += [] if delta is None else [delta]
        zeros = 0
    return b.metric(reference, len(columns), len(times) - 1, tokens)


def expected(parts, width):
    """``parts``: (doc_no, times, values) of one metric, one millisecond of time at a time."""
    held, touched = {}, {}
    for times, values in parts:
        for i, (t, v) in enumerate(zip(times, values)):
            until = times[i + 1] if i + 1 < len(times) else t
            for ms in range(t, max(until, t + 1)):
                window = ms // width * width
                touched.setdefault(window, []).append(v)
                if ms < until:
                    held.setdefault(window, []).append(v)
    out = {}
    for window, values in touched.items():
        inside = held.get(window, [])
        out[window] = (len(inside), sum(inside) / len(inside) if inside else None, min(values), max(values), values[-1])
    return out


def got(rows, name):
    return {r.window_ms: (r.held_ms, r.mean_value, r.min_value, r.max_value, r.last_value) for r in rows if r["name"] == name}


def test_values_are_carried_over_windows_without_samples(spark):
    rows = rollup(chunks(spark, [body([5, 8, 47, 50], x=[3, 7, 7, 9])]), 10).collect()
    assert got(rows, "x") == {
        0: (5, (3 * 3 + 2 * 7) / 5, 3, 7, 7), 10: (10, 7.0, 7, 7, 7), 20: (10, 7.0, 7, 7, 7), 30: (10, 7.0, 7, 7, 7),
        40: (10, 7.0, 7, 7, 7), 50: (0, None, 9, 9, 9)}


def test_random_chunks_equal_dense_samples(spark):
    rng = random.Random(5)
    at, bodies, parts = -500, [], {"x": [], "y": []}
    for _ in range(12):
        n = rng.choice([1, 2, 30, 80])
        times = [at := at + rng.choice([0, 0, 1, 3, 9, 70]) for _ in range(n)]
        x = [rng.choice([0, 0, 0, 5, -(2**62), 2**62]) for _ in times]
        y = [rng.randrange(100)] * n
        bodies.append(body(times, x=x, y=y))
        parts["x"].append((times, x))
        parts["y"].append((times, y))
        at += rng.randrange(1, 40)
    for width in (1, 25, 64, MOST_MS):
        rows = rollup(chunks(spark, bodies), width).collect()
        for name, p in parts.items():
            have, want = got(rows, name), expected(p, width)
            assert have.keys() == want.keys()
            for window, (held, mean, *rest) in want.items():
                assert have[window][0] == held and list(have[window][2:]) == rest, (name, width, window)
                assert have[window][1] == (pytest.approx(mean, rel=1e-12) if mean is not None else None)


def test_parts_follow_changes_not_samples(spark):
    flat = chunks(spark, [body(list(range(0, 3000, 10)), x=[4] * 300)])
    assert value_changes(flat).filter("name = 'x'").count() == 1
    parts = window_parts(flat, 1000).filter("name = 'x'").orderBy("window_ms").collect()
    assert [(p.from_ms, p.to_ms, p.closes) for p in parts] == [(0, 1000, True), (1000, 2000, True), (2000, 2990, True)]


def test_clock_that_falls_and_chunks_without_axis(spark):
    rows = got(rollup(chunks(spark, [body([20, 12, 14], x=[1, 2, 3])]), 10).collect(), "x")
    assert rows == {20: (0, None, 1, 1, 1), 10: (2, 2.0, 2, 3, 3)}
    bare = b.metric({"x": b.int64(1)}, 1, 1, [5])
    good = body([1, 2], x=[1, 2])
    assert {r.doc_no for r in window_parts(chunks(spark, [bare, good], mode="permissive"), 10).collect()} == {1}
    assert rollup(chunks(spark, [good]).limit(0), 10).collect() == []


def test_width_is_checked(spark):
    for width in (0, -1, MOST_MS + 1):
        with pytest.raises(ValueError):
            rollup(chunks(spark, [body([1], x=[1])]), width)

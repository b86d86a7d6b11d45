import random
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests import brute
from wayfold.config import DEFAULTS
from wayfold.operators.dbscan import DENSE_WIDTH, label_frames, label_long_frame
from wayfold.operators.labels import cluster_frames

PARAMS = {"eps": 0.001, "min_samples": 5, "time_scale": 300.0}


def dense(points, pad=0):
    n, width = len(points), len(points) + pad
    x, y, t = np.zeros((3, 1, width))
    t = t.astype(np.int64)
    valid = np.zeros((1, width), bool)
    if n:
        x[0, pad:], y[0, pad:], t[0, pad:] = (np.array(c) for c in zip(*points))
    valid[0, pad:] = True
    return label_frames(x, y, t, valid, valid, **PARAMS)[0, pad:].tolist()


def long(points):
    x, y, t = (np.array(c) for c in zip(*points))
    return label_long_frame(x.astype(float), y.astype(float), t.astype(np.int64), **PARAMS).tolist()


def both(points):
    got = long(points)
    assert got == brute.dbscan(points)
    if len(points) + 7 <= DENSE_WIDTH:
        assert got == dense(points)
        assert got == dense(points, pad=7)
    return got


def test_parked():
    assert both([(106.6, 10.7, 10 * i) for i in range(30)]) == [0] * 30


def test_driving():
    assert both([(106.6 + 0.0008 * i, 10.7, 10 * i) for i in range(30)]) == [-1] * 30


def test_two_stops_are_numbered_in_time_order():
    points = [(106.6 + 0.01 * (i >= 15), 10.7, 10 * i) for i in range(30)]
    assert both(points) == [0] * 15 + [1] * 15


def test_border_point_takes_the_lowest_cluster():
    # Seven points left, seven right, and one in the middle within reach of one core point of each.
    left = [(0.0, 0.0, i) for i in range(7)]
    right = [(0.002 - 1e-5, 0.0, i) for i in range(20, 27)]
    middle = [(0.001 - 5e-6, 0.0, 13)]
    points = sorted(left + right + middle, key=lambda p: p[2])
    assert both(points)[7] == 0


def test_distance_exactly_eps_counts():
    points = [(0.0, 0.0, 0)] * 1 + [(0.001, 0.0, 0)] * 4
    assert brute.dbscan(points) == [0] * 5
    assert dense(points) == [0] * 5


def test_single_and_few_points():
    assert both([(1.0, 1.0, 5)]) == [-1]
    assert both([(1.0, 1.0, i) for i in range(4)]) == [-1] * 4
    assert both([(1.0, 1.0, i) for i in range(5)]) == [0] * 5


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("spread", [0.0005, 0.002, 0.005])
def test_random_walks(seed, spread):
    rng = random.Random(seed)
    x = y = 0.0
    points = []
    for t in sorted(rng.sample(range(900), rng.choice([12, 31, 40, 120]))):
        x += rng.uniform(-spread, spread) / 2
        y += rng.uniform(-spread, spread) / 2
        points.append((round(x, 6), round(y, 6), t))
    both(points)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(0, 900)),
        min_size=5,
        max_size=45,
        unique_by=lambda p: p[2],
    )
)
def test_lattice_points_with_exact_distances(raw):
    both([(x * 0.0002, y * 0.0002, t) for x, y, t in sorted(raw, key=lambda p: p[2])])


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10_000))
def test_a_far_point_changes_nothing(seed):
    rng = random.Random(seed)
    points = [(rng.uniform(0, 0.003), rng.uniform(0, 0.003), 10 * i) for i in range(30)]
    with_far = points + [(9.0, 9.0, 301)]
    assert both(with_far) == both(points) + [-1]


def test_many_frames_at_once_equal_single_frames():
    rng = np.random.default_rng(3)
    frames, width = 200, 31
    x = np.cumsum(rng.uniform(-4e-4, 4e-4, (frames, width)), axis=1)
    y = np.cumsum(rng.uniform(-4e-4, 4e-4, (frames, width)), axis=1)
    t = np.cumsum(rng.integers(1, 25, (frames, width)), axis=1)
    valid = np.ones((frames, width), bool)
    got = label_frames(x, y, t, valid, valid, **PARAMS)
    for k in range(frames):
        assert got[k].tolist() == brute.dbscan(list(zip(x[k], y[k], t[k].tolist())))


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_windows_over_a_buffer_equal_single_frames(data):
    """The shared neighbour band, with lattice distances that fall exactly on the radius."""
    n = data.draw(st.integers(2, 90))
    gaps = data.draw(st.lists(st.integers(1, 60), min_size=n, max_size=n))
    cells = data.draw(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8)), min_size=n, max_size=n))
    x, y = (np.array([c[k] * 0.0002 for c in cells]) for k in (0, 1))
    t = 1_704_067_200 + np.cumsum(gaps)
    group = np.where(np.arange(n) >= n // 3, n // 3, 0)
    last = np.arange(n)
    low = np.maximum(group, last - 30)
    speed = np.full(n, 5.0)
    got = cluster_frames(x, y, t, speed, low, last, last, replace(DEFAULTS, frame_points=5))
    for k in range(n):
        frame = list(zip(x[low[k] : k + 1], y[low[k] : k + 1], t[low[k] : k + 1].tolist()))
        labels = brute.dbscan(frame) if len(frame) >= 5 else [-1]
        assert got.cluster_id[k] == labels[-1]
        assert got.buffer_size[k] == len(frame)
        if labels[-1] >= 0:
            assert got.cluster_points[k] == labels.count(labels[-1])


def test_long_frame_of_a_day():
    rng = np.random.default_rng(5)
    n = 8640
    t = np.arange(n) * 10
    x = np.cumsum(rng.choice([0.0, 0.0, 0.0006], n) * rng.choice([-1, 1], n))
    y = np.cumsum(rng.choice([0.0, 0.0, 0.0006], n) * rng.choice([-1, 1], n))
    labels = label_long_frame(x, y, t, **PARAMS)
    assert labels.tolist() == brute_sweep(x, y, t)


def brute_sweep(x, y, t):
    """The textbook algorithm with neighbours looked up by time."""
    scaled = (t - t[0]) / 300.0 * 0.001
    n = len(t)
    near = []
    for i in range(n):
        lo, hi = np.searchsorted(t, t[i] - 310), np.searchsorted(t, t[i] + 310)
        dx, dy, dt = x[lo:hi] - x[i], y[lo:hi] - y[i], scaled[lo:hi] - scaled[i]
        near.append((lo + np.flatnonzero(np.sqrt(dx * dx + dy * dy + dt * dt) <= 0.001)).tolist())
    labels, number = [-1] * n, 0
    for i in range(n):
        if labels[i] != -1 or len(near[i]) < 5:
            continue
        labels[i], todo = number, [i]
        while todo:
            for j in near[todo.pop()]:
                if labels[j] == -1:
                    labels[j] = number
                    if len(near[j]) >= 5:
                        todo.append(j)
        number += 1
    return labels

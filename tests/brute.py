"""Textbook density clustering and a one-row-at-a-time frame model, to check the fast forms against."""

from __future__ import annotations

import math


def dbscan(points, eps=0.001, min_samples=5, time_scale=300.0):
    """Labels of (x, y, seconds) points in time order."""
    n = len(points)
    first = min(p[2] for p in points)
    scaled = [(x, y, (t - first) / time_scale * eps) for x, y, t in points]

    def close(a, b):
        dx, dy, dt = (p - q for p, q in zip(a, b))
        return math.sqrt(dx * dx + dy * dy + dt * dt) <= eps

    near = [[j for j in range(n) if close(scaled[i], scaled[j])] for i in range(n)]
    core = [len(near[i]) >= min_samples for i in range(n)]
    labels = [-1] * n
    number = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        todo = [i]
        labels[i] = number
        while todo:
            k = todo.pop()
            for j in near[k]:
                if labels[j] == -1:
                    labels[j] = number
                    if core[j]:
                        todo.append(j)
        number += 1
    return labels


def label_steps(steps, frame_points=30, scope="emitted"):
    """Feed one vehicle's batches of (x, y, speed, seconds) through a rolling frame.

    Yields (seconds, cluster, status, tti, severity, frame size) for each new point.
    """
    held: dict[int, tuple] = {}
    for batch in steps:
        held.update({row[3]: row for row in batch})
        new = {row[3] for row in batch}
        frame = [held[t] for t in sorted(held)]
        size = len(frame)
        labels = dbscan([(r[0], r[1], r[3]) for r in frame]) if size >= frame_points else [-1] * size
        for row, label in zip(frame, labels):
            if row[3] not in new:
                continue
            status = "Warming Up" if size < frame_points else "Smooth"
            tti = _round(40.0 / max(row[2], 1.0), 3)
            severity = 0.0
            if label >= 0:
                status = "Congested"
                members = [r for r, c in zip(frame, labels) if c == label]
                xs, ys = [r[0] for r in members], [r[1] for r in members]
                ew = (max(xs) - min(xs)) * 111320.0 * 0.982287
                ns = (max(ys) - min(ys)) * 111320.0
                if max(r[2] for r in members) < 3.0 and math.sqrt(ew * ew + ns * ns) < 15.0:
                    status = "Dwelling"
                counted = len(members) if scope == "frame" else sum(r[3] in new for r in members)
                density = min(max(counted / 5, 1.0), 5.0)
                severity = _round(density * min(max(tti / 2.0, 0.0), 5.0), 2)
            yield row[3], label, status, tti, severity, size
        held = {t: held[t] for t in sorted(held)[-frame_points:]}


def _round(value, digits):
    return round(value * 10**digits) / 10**digits

"""Density labels for small frames of time-ordered points (numpy, used inside Spark tasks).

Points are (x, y, scaled time). A core point has at least `min_samples` points
within `eps`, itself included. Clusters are numbered by their earliest core
point; a border point takes the lowest-numbered cluster in reach; noise is -1.
"""

from __future__ import annotations

import numpy as np

# Frames up to this width keep each row of neighbours in one 64-bit word.
DENSE_WIDTH = 64
_PAIRS_AT_ONCE = 1 << 20

# Pairs this close to the radius (as a share of it) are decided frame by frame.
_UNSURE = 1e-6


def _scaled_time(t, first, eps, time_scale):
    return (t - first).astype(np.float64) / time_scale * eps


def near_pairs(x, y, t, valid, *, eps, time_scale):
    """Which points of each frame are within `eps`; arrays are (frames, width), False in `valid` is padding."""
    first = np.where(valid, t, np.iinfo(np.int64).max).min(axis=1)[:, None]
    ts = _scaled_time(t, first, eps, time_scale)
    dist = x[:, :, None] - x[:, None, :]
    dist *= dist
    step = y[:, :, None] - y[:, None, :]
    step *= step
    dist += step
    np.subtract(ts[:, :, None], ts[:, None, :], out=step)
    step *= step
    dist += step
    np.sqrt(dist, out=dist)
    return dist <= eps


class Band:
    """Neighbours of each row among the rows just before it, shared by all frames over a buffer.

    Time counts from the start of a frame, which changes the last digits of a
    distance. So only pairs clearly inside or outside the radius are settled
    here; `unsure` marks rows that have any other pair.
    """

    def __init__(self, x, y, t, width, *, eps, time_scale):
        n = len(x)
        self.width = width
        near = np.zeros((n, width), bool)
        near[:, 0] = True
        self.unsure = np.zeros(n, bool)
        for back in range(1, min(width, n)):
            dx, dy = x[back:] - x[:-back], y[back:] - y[:-back]
            dt = _scaled_time(t[back:], t[:-back], eps, time_scale)
            dist = np.sqrt(dx * dx + dy * dy + dt * dt)
            near[back:, back] = dist <= eps
            self.unsure[back:] |= np.abs(dist - eps) <= eps * _UNSURE
        # Pair (a, b <= a) of a frame that begins at row r is element
        # r * width + a * (width + 1) - b of the flattened table.
        flat = np.concatenate([np.zeros(width, bool), near.ravel(), np.zeros(width * width, bool)])
        self.pairs = np.lib.stride_tricks.as_strided(
            flat[width:], shape=(n, width, width), strides=(width, width + 1, -1), writeable=False
        )
        self.lower = np.tri(width, dtype=bool)

    def near_pairs(self, begin):
        near = self.pairs[begin] & self.lower
        near |= near.transpose(0, 2, 1)
        return near


def labels_from_near(near, valid, wanted, min_samples):
    """Labels of many frames from their neighbour tables, at most 64 points wide.

    `wanted` marks the points whose labels will be used. Frames without a
    clustered wanted point are left at -1 throughout.
    """
    frames, width, _ = near.shape
    labels = np.full((frames, width), -1, np.int32)
    present = _words(valid[:, None, :])
    around = _words(near) & present
    around[~valid] = 0
    core = np.bitwise_count(around) >= min_samples
    reach = around & _words(core[:, None, :])
    active = np.flatnonzero(((reach != 0) & wanted).any(axis=1))
    if active.size == 0:
        return labels
    reach, core = reach[active], core[active]

    # Transitive closure: whoever reaches point k reaches all that k reaches.
    one = np.uint64(1)
    for k in range(width):
        through = (reach >> np.uint64(k)) & one
        reach |= (~through + one) & reach[:, k : k + 1]

    # The lowest bit is the earliest core point of the cluster.
    root = reach & (~reach + one)
    roots = np.bitwise_or.reduce(np.where(core, root, np.uint64(0)), axis=1)[:, None]
    number = np.bitwise_count(roots & (root - one)).astype(np.int32)
    labels[active] = np.where(reach != 0, number, -1)
    return labels


def _words(bits):
    """Pack the last axis of up to 64 booleans into one word, first element lowest."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    padded = np.zeros((*packed.shape[:-1], 8), np.uint8)
    padded[..., : packed.shape[-1]] = packed
    return padded.view("<u8")[..., 0]


def label_frames(x, y, t, valid, wanted, *, eps, min_samples, time_scale):
    """Labels of many frames, all distances measured anew for each."""
    near = near_pairs(x, y, t, valid, eps=eps, time_scale=time_scale)
    return labels_from_near(near, valid, wanted, min_samples)


def label_long_frame(x, y, t, *, eps, min_samples, time_scale):
    """Labels of one frame of any length, sorted by time.

    Two points further apart than `time_scale` seconds are never neighbours, so
    only pairs within that span are measured.
    """
    n = len(t)
    ts = _scaled_time(t, t[0], eps, time_scale)
    # One second of slack: the exact test below decides.
    earliest = np.searchsorted(t, t - int(time_scale) - 1, side="left")
    later, earlier = [], []
    begin = 0
    while begin < n:
        reach = np.cumsum(np.arange(begin, n) - earliest[begin:n])
        end = begin + max(1, int(np.searchsorted(reach, _PAIRS_AT_ONCE)))
        counts = np.arange(begin, end) - earliest[begin:end]
        i = np.repeat(np.arange(begin, end), counts)
        j = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(earliest[begin:end], counts)
        dx, dy, dt = x[i] - x[j], y[i] - y[j], ts[i] - ts[j]
        near = np.sqrt(dx * dx + dy * dy + dt * dt) <= eps
        later.append(i[near])
        earlier.append(j[near])
        begin = end
    i, j = np.concatenate(later), np.concatenate(earlier)

    neighbours = 1 + np.bincount(i, minlength=n) + np.bincount(j, minlength=n)
    core = neighbours >= min_samples
    label = np.where(core, np.arange(n), n)
    both = core[i] & core[j]
    ci, cj = i[both], j[both]
    padded = np.append(label, n)
    while True:
        new = padded.copy()
        low = np.minimum(padded[ci], padded[cj])
        np.minimum.at(new, ci, low)
        np.minimum.at(new, cj, low)
        # Hook the old roots too, so that whole trees merge in one round.
        np.minimum.at(new, padded[ci], low)
        np.minimum.at(new, padded[cj], low)
        new = new[new]
        if np.array_equal(new, padded):
            break
        padded = new

    root = padded.copy()
    np.minimum.at(root, i, np.where(core[j], padded[j], n))
    np.minimum.at(root, j, np.where(core[i], padded[i], n))
    number = np.append(np.cumsum(core & (padded[:n] == np.arange(n))) - 1, -1)
    return number[root[:n]].astype(np.int32)

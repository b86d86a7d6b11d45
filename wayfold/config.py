"""Every tunable number in one place."""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Results agree with existing deployments only with these
    # defaults. `block_s` alone is free.

    # Grid and geometry.
    grid_resolution: float = 0.001
    metres_per_degree: float = 111_320.0
    cos_latitude: float = math.cos(math.radians(10.8))
    dwell_cos_latitude: float = 0.982287

    # Stop proximity (optional filter).
    stop_speed_kmh: float = 5.0
    stop_radius_m: float = 30.0

    # Density clustering of one vehicle's recent points; time is scaled so that
    # `time_scale_s` seconds weigh as much as `eps` degrees.
    eps: float = 0.001
    min_samples: int = 5
    time_scale_s: float = 300.0

    # Rolling frame per vehicle.
    frame_points: int = 30
    idle_timeout_s: int = 30 * 60

    # A cluster that hardly moves is a parked vehicle, not congestion.
    dwell_max_speed_kmh: float = 3.0
    dwell_max_diagonal_m: float = 15.0

    # Scoring and the live table.
    free_flow_speed_kmh: float = 40.0
    live_ttl_s: int = 600
    top_cells: int = 200
    episode_gap_s: int = 30

    # Streams and replay.
    watermark_s: int = 5 * 60
    slice_s: int = 10
    replay_head_s: int = 2 * 60 * 60

    # A vehicle's history is cut into blocks of this many seconds, so that one
    # busy vehicle is spread over many tasks. One row per second at most is left
    # after deduplication, which bounds a block. Choose it so that a usual block
    # holds far more than `frame_points` rows, since each block repeats that many.
    block_s: int = 24 * 60 * 60


DEFAULTS = Settings()

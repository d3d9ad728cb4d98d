"""Parameters of the models, with the values the models use by default."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Limits of the alert and severity rules (degrees C, mm, km/h, UV index)."""

    heat: float = 40
    frost: float = 0
    rain: float = 80
    wind: float = 90
    uv: float = 11
    temp_anomaly: float = 5
    rain_anomaly: float = 40
    critical_heat: float = 45
    critical_rain: float = 150


ROLLING_ROWS = 30

# A side of a join is broadcast only after its size was measured to be at most this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# The same for the months that a refresh reaches: one refresh joins them up to nine times, and the driver builds each table of a broadcast itself.
REACHED_LIMIT_BYTES = 1024 * 1024

# Stored bytes a shuffle partition should stand for.
SHUFFLE_PARTITION_BYTES = 64 * 1024 * 1024

# Rows of a mart's file, at most.
ROWS_PER_FILE = 1_000_000

# Rows of one location in a folder of a batch, from which on repeats of a key are left out before the shuffle.
HOT_ROWS = 100_000

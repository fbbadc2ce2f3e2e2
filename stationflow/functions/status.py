"""Station-level derived measures: availability ratio and status class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schemas import STATE_MAINTENANCE, STATE_REFORMED

# Fixed status names, in rule priority order.
STATUS_REFORMED = "reformed"
STATUS_MAINTENANCE = "maintenance"
STATUS_EMPTY = "empty"
STATUS_LOW = "low"
STATUS_FULL = "full"
STATUS_OK = "ok"
LOW_BIKES_MAX = 4


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def availability_ratio(bikes="nb_available_bikes", places="nb_available_places") -> Column:
    """bikes / (bikes + places); null when the station has no dock at all."""
    b, p = _c(bikes), _c(places)
    return F.try_divide(b.cast("double"), (b + p).cast("double"))


def station_status(state="operational_state", bikes="nb_available_bikes",
                   places="nb_available_places") -> Column:
    """First matching rule wins: reformed, maintenance, no bike = empty,
    1–4 bikes = low, no free place = full, otherwise ok."""
    s, b, p = _c(state), _c(bikes), _c(places)
    return (F.when(s == STATE_REFORMED, STATUS_REFORMED)
            .when(s == STATE_MAINTENANCE, STATUS_MAINTENANCE)
            .when(b == 0, STATUS_EMPTY)
            .when(b.between(1, LOW_BIKES_MAX), STATUS_LOW)
            .when(p == 0, STATUS_FULL)
            .otherwise(STATUS_OK))

from flightloom.streaming.drain import drain, drain_typed, drain_unique, unique_stream
from flightloom.streaming.flight_max import (
    Drained,
    drain_flight_max,
    latest_maxima,
    windowed_maxima,
)
from flightloom.streaming.land import land_topic

__all__ = [
    "Drained",
    "drain",
    "drain_flight_max",
    "drain_typed",
    "drain_unique",
    "land_topic",
    "latest_maxima",
    "unique_stream",
    "windowed_maxima",
]

from flightloom.plans.flight_max import (
    bucketed_flight_max,
    flight_max_offset,
    publish_flight_max,
    save_flight_buckets,
)
from flightloom.plans.landing import land_batch, land_csv
from flightloom.plans.roundtrip import round_trip
from flightloom.plans.route import filter_and_route

__all__ = [
    "bucketed_flight_max",
    "filter_and_route",
    "flight_max_offset",
    "land_batch",
    "land_csv",
    "publish_flight_max",
    "round_trip",
    "save_flight_buckets",
]

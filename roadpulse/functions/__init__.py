from roadpulse.functions.geo import (
    bounding_box,
    cell_index,
    cell_to_degrees,
    grid_box,
    grid_degree,
    haversine_km,
    round_half_up,
)
from roadpulse.functions.times import (
    day_start,
    event_time,
    in_interval,
    iso_weekday,
    parse_event_time,
    record_date,
)
from roadpulse.functions.words import split_lines, split_words

__all__ = [
    "bounding_box",
    "cell_index",
    "cell_to_degrees",
    "day_start",
    "event_time",
    "grid_box",
    "grid_degree",
    "haversine_km",
    "in_interval",
    "iso_weekday",
    "parse_event_time",
    "record_date",
    "round_half_up",
    "split_lines",
    "split_words",
]

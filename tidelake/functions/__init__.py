"""Column functions: durations and text classes."""

from tidelake.functions.durations import UNITS_PER_HOUR, with_duration
from tidelake.functions.text import CITY_CLASSES, contains, exclusive_class, overlapping_classes, starts_with

__all__ = [
    "CITY_CLASSES",
    "UNITS_PER_HOUR",
    "contains",
    "exclusive_class",
    "overlapping_classes",
    "starts_with",
    "with_duration",
]

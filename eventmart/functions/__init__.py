"""Column expressions: calendar fields, keys, text repair, NULL defaults."""

from eventmart.functions.calendar import date_key, time_key, with_calendar
from eventmart.functions.keys import location_key, song_key, surrogate_key
from eventmart.functions.nulls import default_guests, text_identity
from eventmart.functions.text import repair_text

__all__ = [
    "date_key",
    "default_guests",
    "location_key",
    "repair_text",
    "song_key",
    "surrogate_key",
    "text_identity",
    "time_key",
    "with_calendar",
]

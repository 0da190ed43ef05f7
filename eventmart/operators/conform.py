"""The three cleaned event frames the star schema is built from."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from eventmart.functions.nulls import GUEST_IDS, default_guests, text_identity


class Activity(NamedTuple):
    """Events with ``userId`` and ``registration`` as text, guests completed."""

    listen: DataFrame
    auth: DataFrame
    page_view: DataFrame


def conform(
    listen: DataFrame,
    auth: DataFrame,
    page_view: DataFrame,
    guest_ids: tuple[str, str] = GUEST_IDS,
) -> Activity:
    """Bring landed topics to common types; only page views have guests.

    With the default ids a paid guest is one with a registered user number 1;
    pass others to keep them apart.
    """
    return Activity(
        text_identity(listen), text_identity(auth), default_guests(page_view, guest_ids)
    )

"""NULL defaults and text identity of events on their way into the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMPTY = "empty"
GUEST_IDS = ("0", "1")  # fixed values: free guest, any other guest


def text_identity(df: DataFrame) -> DataFrame:
    """``userId`` and ``registration`` as text, the form all topics share."""
    return df.withColumns(
        {
            "userId": F.col("userId").cast("string"),
            "registration": F.col("registration").cast("string"),
        }
    )


def default_guests(df: DataFrame, guest_ids: tuple[str, str] = GUEST_IDS) -> DataFrame:
    """Give page views of visitors without an account a complete identity.

    The guest id depends on ``level`` before it is filled: ``free`` gives the
    first id, anything else, NULL included, the second. Missing text becomes
    ``empty``, a missing or NaN duration 0.0; other numbers stay NULL.
    """
    free, other = guest_ids
    guest = F.when(F.col("level") == "free", F.lit(free)).otherwise(F.lit(other))
    return (
        text_identity(df)
        .withColumn("userId", F.coalesce("userId", guest))
        .fillna({"duration": 0.0})
        .fillna(EMPTY)
    )

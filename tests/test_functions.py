from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from conftest import rows
from eventmart.functions import (
    date_key,
    default_guests,
    location_key,
    repair_text,
    song_key,
    surrogate_key,
    text_identity,
    time_key,
    with_calendar,
)


def test_calendar_uses_iso_weeks_and_sunday_first(spark):
    df = spark.sql("select timestamp'2023-01-01 23:59:58' as ts")
    assert with_calendar(df).drop("ts").first().asDict() == {
        "hour": 23,
        "minute": 59,
        "second": 58,
        "day": 1,
        "dayOfWeek": 1,
        "week": 52,
        "month": 1,
        "year": 2023,
        "quarter": 1,
    }


def test_calendar_of_missing_time_is_missing(spark):
    df = with_calendar(spark.sql("select cast(null as timestamp) as ts"))
    assert set(df.first()) == {None}


def test_time_keys_are_fixed_width(spark):
    df = spark.sql(
        "select explode(array(timestamp'2024-03-05 00:00:07', timestamp'2024-12-31 23:59:59')) ts"
    )
    assert rows(df.select(date_key("ts"), time_key("ts"))) == [
        ("20240305", "000007"),
        ("20241231", "235959"),
    ]


def test_keys_separate_shifted_text_and_join_signed_zero(spark):
    df = spark.createDataFrame([("ab", "c", 0.0), ("a", "bc", 0.0), ("ab", "c", -0.0)], "t string, a string, d double")
    first, second, third = [r[0] for r in df.select(song_key("t", "a", "d")).collect()]
    assert first != second
    assert first == third


def test_key_of_incomplete_member_is_null(spark):
    df = spark.createDataFrame([("c", None, "s", 1.0, 2.0)], "c string, z string, s string, x double, y double")
    assert df.select(location_key("c", "z", "s", "x", "y")).first()[0] is None


def test_key_is_the_same_in_any_plan(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    key = surrogate_key(F.col("v")).alias("k")
    assert rows(df.select("v", key)) == rows(df.repartition(7, "v").select("v", key))


def test_guest_ids_follow_level_before_it_is_filled(make_topic):
    df = make_topic(
        "page_view_events",
        [dict(userId=None, level=level) for level in ("free", "paid", None)] + [dict(userId=9)],
    )
    assert rows(default_guests(df).select("userId", "level")) == [
        ("0", "free"),
        ("1", "empty"),
        ("1", "paid"),
        ("9", "free"),
    ]
    own = default_guests(df, ("g-free", "g-other")).select("userId").distinct()
    assert rows(own) == [("9",), ("g-free",), ("g-other",)]


def test_guest_defaults_fill_text_and_duration_only(make_topic):
    df = make_topic(
        "page_view_events",
        [
            dict(
                song=None, artist=None, duration=None, gender=None, city=None, lon=None,
                sessionId=None, status=None, registration=None,
            ),
            dict(duration=float("nan")),
        ],
    )
    filled, nan = default_guests(df).orderBy("song", ascending=False).collect()
    assert (filled.song, filled.artist, filled.gender, filled.city) == ("empty",) * 4
    assert filled.registration == "empty"
    assert filled.duration == 0.0 and nan.duration == 0.0
    assert filled.lon is None and filled.sessionId is None and filled.status is None


def test_text_identity_trims_fraction_of_registration(make_topic):
    df = make_topic("auth_events", [dict(userId=12, registration="2023-10-01 00:00:00.100")])
    assert rows(text_identity(df).select("userId", "registration")) == [
        ("12", "2023-10-01 00:00:00.1")
    ]


REPAIRS = {
    "BeyoncÃ©": "Beyoncé",
    "Beyoncé": "Beyoncé",
    "日本": "日本",
    '"Plain"': "Plain",
    "": "",
    r"Beyonc\u00c3\u00a9": "Beyoncé",
    r"Beyonc\U000000c3\xa9": "Beyoncé",
    r"Beyonc\xc3\xa9": "Beyoncé",
    r"Beyonc\303\251": "Beyoncé",
    "tail\\": "tail\\",
    r"a\x4": r"a\x4",
    r"over \477": r"over \477",
    r"wide \u0100": r"wide \u0100",
    r"keep \q": r"keep \q",
    r"back\\slash": "back\\slash",
    "日\\x41": "日\\x41",
    r'"\"both\""': "both",
    "two\\\nlines": "twolines",
}


def test_repair_text_literals(spark):
    df = spark.createDataFrame([*((v,) for v in REPAIRS), (None,)], "v string")
    got = {r.v: r.fixed for r in df.select("v", repair_text("v").alias("fixed")).collect()}
    assert got == {**REPAIRS, None: None}


def _decoded_by_codecs(text):
    """The same repair spelled with Python's codecs, for comparison only."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            raw = text.encode("latin-1").decode("unicode-escape").encode("latin-1")
        return raw.decode("utf-8").strip('"')
    except (UnicodeEncodeError, UnicodeDecodeError):
        return text.strip('"')


def test_repair_text_agrees_with_codecs_on_generated_text(spark):
    import random

    draw = random.Random(11)
    pieces = ["\\", "x", "u", "U", "N", "c3", "a9", "00", "3", "0", "7", "8", "Ã", "©", "é", '"',
              "'", "n", "t", "\n", " ", "a", "z", "ÿ", "€"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(1, 9))) for _ in range(4000)]
    texts = sorted({t for t in texts if "\\N" not in t})
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    wrong = [
        (r.v, r.fixed, _decoded_by_codecs(r.v))
        for r in df.select("v", repair_text("v").alias("fixed")).collect()
        if r.fixed != _decoded_by_codecs(r.v)
    ]
    assert wrong == []


def test_repair_text_handles_long_text(spark):
    df = spark.sql(r"select repeat('x\\u0041Ã©', 50000) as v")
    assert df.select(repair_text("v")).first()[0] == "xAé" * 50000

"""Time the headline queries; prints one JSON line.

Each query is run to the end by writing its rows to a no-op sink. The first
run of a session pays for JVM start and class loading, so a small query is run
once, untimed, before the clock starts. ``warehouse_load`` is the landing of
three topics and the full load of the star schema; the questions after it read
the stored tables.
"""

from __future__ import annotations

import json
import os
import time

from eventmart import session
from eventmart.registry.queries import all_queries, stored_topics, stored_warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "prepare_topics",
    "listen_count_minute",
    "song_chart_minute",
    "artist_chart_minute",
    "user_activity_minute",
    "gender_distribution_minute",
    "user_login",
    "decode_listen_events",
    "dim_song",
    "dim_user",
    "dim_location",
    "new_dim_user",
    "new_fact_listen",
    "warehouse_load",
    "incremental_load_counts",
    "fact_listen",
    "fact_auth",
    "fact_page_view",
    "fact_listen_by_version",
    "fact_listen_by_join",
    "logged_in_users_day",
    "logged_in_users_minute",
    "top_songs_day",
    "top_artists_month",
    "top_locations",
    "songs_played_hour",
    "user_distribution",
    "avg_songs_per_user",
    "latest_minutes",
    "stream_listen_count_minute",
    "stream_song_chart_minute",
    "landed_stream",
    "repair_text",
]


def main() -> None:
    spark = session.build(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    steps = {"prepare_topics": stored_topics, "warehouse_load": stored_warehouse}
    spark.read.parquet(f"{SF_DIR}/nation.parquet").groupBy("n_regionkey").count().collect()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        if name in steps:
            steps[name](spark, SF_DIR)
        else:
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from matchloom.session import build_session
from matchloom.workloads import QUERIES
from matchloom.workloads.inputs import Layers

# Built in this order, each from the stored layer before it.
LAYERS = [
    ("bronze", ("accounts", "matches", "timelines")),
    ("parsed", ("matches", "timelines")),
    ("silver", ("accounts", "matches", "match_teams", "match_participants", "timeline_frames",
                "timeline_events")),
    ("gold", ("team_stats", "player_performance", "draft", "player_frames_indexed")),
]
HEADLINE = [
    "tbl_silver_match_participants", "tbl_silver_timeline_frames", "tbl_gold_team_stats",
    "tbl_gold_player_performance", "tbl_gold_draft", "tbl_gold_player_frames_indexed",
    "tbl_silver_validation", "tbl_gold_validation", "rpt_champion_pool", "rpt_form_trend",
    "rpt_draft_analysis", "merge_upsert_star", "join_three_way", "join_left_lookup",
    "win_latest_player", "win_frame_index", "agg_dup_keys", "agg_player_map", "latest_n",
]
# Whole writes of stored tables, run once.
STORED = ["sink_upsert_stored", "pipe_gold", "stream_foreach_upsert"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "matchloom-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    layers, times = Layers(spark, sf_dir), {}

    for layer, names in LAYERS:
        for name in names:
            start = time.perf_counter()
            getattr(layers, layer)(name)
            times[f"store_{layer}_{name}"] = round(time.perf_counter() - start, 3)

    for name in HEADLINE + STORED:
        laps = []
        for _ in range(1 if name in STORED else runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(sorted(laps)[len(laps) // 2], 3)
        print(name, times[name], file=sys.stderr)

    print(
        json.dumps(
            {
                "metric": "total seconds: stored layers once, headline queries by median",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

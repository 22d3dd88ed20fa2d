"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per
query after one warm-up (the median counts), BENCH_QUERIES an optional comma-separated choice.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexloom.plans.catalog import QUERIES  # noqa: E402
from lexloom.session import build_session  # noqa: E402

HEADLINE = [
    "a01_vocab_count",
    "a10_word_scores",
    "t04_l_tokens",
    "t05_wordpiece",
    "t07_encode_ids",
    "a11_spacing_train",
    "a12_spacing_apply",
    "a13_cooccurrence",
    "a16_tfidf",
    "r07_to_jamo",
    "r09_strip_markup",
    "s13_shards",
    "v01_sentence_vectors",
    "v03_nearest_label",
    "p03_sentence_pairs",
    "p04_masks",
    "p06_windows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


main()

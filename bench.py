"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the data folder, `BENCH_CPUS` the number of local cores.
Each query is timed from building its plan to consuming every row.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from courtloom.operators import load, normalize  # noqa: E402
from courtloom.plans.queries import QUERIES  # noqa: E402
from courtloom.plans.staging import staged  # noqa: E402
from courtloom.session import session, work_path  # noqa: E402
from courtloom.sources import demo  # noqa: E402

HEADLINE = (
    "training_extract",
    "topic_extract",
    "case_types_by_family",
    "outcome_label",
    "court_type_ffill",
    "features_general",
    "split_decided",
    "frontier_unseen",
    "search_grid",
    "unparsed_pages",
    "whitespace_norm",
    "tree_accuracy",
)


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus}
    spark = session(f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, run):
        start = time.time()
        run()
        times[name] = round(time.time() - start, 3)

    raw = staged(spark, folder, "raw", lambda: demo.raw_pages(spark, folder))
    entries, path = {}, work_path(spark, "bench")

    def parse():
        parsed = load.load(normalize.parse_pages(raw))
        entries["staged"] = load.stage_entries(parsed, f"{path}/_staged")

    timed("parse_pages", parse)
    timed("store_eight_tables", lambda: load.store_tables(entries["staged"], path))
    for name in HEADLINE:
        timed(name, lambda: consume(QUERIES[name](spark, folder)))
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

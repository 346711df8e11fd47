"""Times the headline queries and prints one JSON line."""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
from augury import catalog  # noqa: E402
from augury.sources import fixtures  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Queries and the input whose rows each of them goes through.
HEADLINE = {
    "market_volume": "logs", "fill_facts": "logs", "fill_gaps": "logs", "key_audit": "logs", "latest_fill": "logs", "book_at_cut": "book_events", "bbo_timeline": "book_events", "book_digest": "book_events", "tape_sequence": "book_events",
    "interval_coverage": "readiness", "token_lanes": "readiness", "price_asof": "prices", "exact_quantiles": "prices", "adjudication_readiness": "lifecycle", "contiguous_prefix": "book_events",
}
INPUTS = (fixtures.logs, fixtures.markets, fixtures.tokens, fixtures.book_events, fixtures.readiness, fixtures.prices, fixtures.lifecycle)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Inputs are derived and written before the clock starts.
    rows = fixtures.keep(spark, SF_DIR, tempfile.mkdtemp(prefix="bench-"), *INPUTS)
    took = {}
    catalog.QUERIES["market_volume"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # starts Spark and reads once
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total of headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "rows_per_sec": {name: round(rows[HEADLINE[name]] / t) for name, t in took.items()}, "input_rows": rows, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()

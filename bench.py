"""

BENCH_SF_DIR: data folder (default sf0.1).  BENCH_CPUS: local cores (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from checks.queries import QUERIES
from checks.views import messages_sql
from smslens.operators import frequency, stats
from smslens.operators.classify import classify_rules
from smslens.operators.normalize import normalization_report, with_normalized
from smslens.session import build_session
from smslens.sources.messages import delivered_only

EVENT_QUERIES = (
    "message_report", "client_top", "normalization_report", "template_frequency", "template_stats", "rule_classification",
    "label_report", "resolve_votes", "phone_hours", "phone_categories", "score_documents", "phone_profile",
    "near_templates", "minhash_links", "document_templates",
)


def volume(spark, d):
    """Messages from every lineitem row: the volume input (six times the events table)."""
    rows = (
        "SELECT l_orderkey * 10 + l_linenumber AS n, l_shipdate AS ts, l_suppkey AS user_id,"
        " CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'view' END AS kind, l_extendedprice AS value,"
        " l_returnflag AS props FROM {lineitem}"
    )
    return spark.sql(messages_sql(rows), lineitem=spark.read.parquet(f"{d}/lineitem.parquet"))


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    stored = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"bench-{os.getpid()}-{int(time.time())}")
    # The reference reads stored messages; the fixture text is built once, outside the timings.
    volume(spark, d).repartition(2 * cpus).write.parquet(stored)
    messages = spark.read.parquet(stored)
    total = messages.count()
    runs = {
        "volume_read_stats": lambda: stats.message_report(delivered_only(messages)),
        "volume_normalize": lambda: normalization_report(with_normalized(delivered_only(messages))),
        "volume_templates": lambda: frequency.template_frequency(delivered_only(messages), include_pure=True),
        "volume_classified": lambda: classify_rules(frequency.template_frequency(delivered_only(messages))),
    }
    for name in EVENT_QUERIES:
        runs[name] = lambda name=name: QUERIES[name](spark, d)
    times = {}
    for name, run in runs.items():
        start = time.time()
        run().write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    rates = {n: round(total / times[n]) for n in runs if n.startswith("volume_")}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(d.rstrip("/")), "volume_messages": total, "messages_per_sec": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

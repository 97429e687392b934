"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR: table folder. BENCH_CPUS: local cores. Each query writes its whole result to
Spark's no-op sink, so every row and column is computed and nothing reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rolecall.plans.queries import QUERIES  # noqa: E402
from rolecall.session import local_session  # noqa: E402

HEADLINE = [
    "canonical_urls", "platform_labels", "top_domains", "deduped_pages", "page_texts", "page_links",
    "lever_postings", "ats_postings", "posting_keys", "model_responses", "query_cascade",
    "search_payload_hits", "profile_contacts", "fetch_outcomes", "sticky_backends",
    "first_seen_profiles", "found_contacts", "query_yields", "pattern_votes", "name_candidates",
    "contact_addresses", "outbox", "outreach_summary", "send_states", "replaced_contacts",
    "bounce_recipients", "bounce_reconcile", "stream_outcomes", "retry_states",
    "ingested_postings", "contact_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed pass starts the JVM's and Python's workers
    QUERIES["page_texts"](spark, sf_dir).limit(1).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

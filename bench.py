"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Results go to a sink that
discards rows, so nothing is collected by the driver. BENCH_QUERIES limits the run to a list.
"""

from __future__ import annotations

import json
import os
import time

from sluice.plans.catalog import QUERIES
from sluice.session import local_session

HEADLINES = [
    "flagship_ingest",
    "ingest_basic",
    "html_ingest",
    "sql_ingest",
    "messages_ingest",
    "partition_text",
    "partition_html",
    "extract_links",
    "assign_hash_ids",
    "chunk_basic",
    "chunk_by_title",
    "embed_elements",
    "stage_sql",
    "stage_elasticsearch",
    "stage_chroma",
    "stage_vectara",
    "batch_by_count",
    "batch_by_bytes",
    "overwrite_by_record_id",
    "upsert_by_id",
    "incremental_changed",
    "messages_daily_packages",
    "thread_to_xml",
    "tickets_to_text",
    "issues_to_text",
    "block_tree_to_html",
    "graph_nodes",
    "graph_structure_edges",
    "tree_closure",
    "acl_drive",
    "acl_box",
    "uuid5_dns",
    "filter_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    picked = os.environ.get("BENCH_QUERIES")
    names = picked.split(",") if picked else HEADLINES
    spark = local_session(cores, app="bench")
    # Start the JVM code paths and the Python workers outside of the timings.
    QUERIES["embed_elements"](spark, sf_dir).limit(1).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8)
and ``BENCH_RUNS`` (default 3). Every query runs once untimed; its time is the
median of the runs after that, one run where a run takes over ``LONG_SECONDS``.
Every result is computed in full and dropped by a no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tablefold.queries import registry
from tablefold.session import local_session

HEADLINE = [
    "delimiters", "parsed_cells", "column_dtypes", "star_column_dtypes", "event_ids", "url_sample", "segment_assignment",
    "file_names_prefix", "licensed_documents", "graph_ontology", "nearest_label", "syntactic_types", "table_domains",
    "anonymized_rows", "bias_top_values", "corpus_tables", "semantic_types",
]
LONG_SECONDS = 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, shuffle_partitions=int(cores))
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            if len(taken) > 1 and taken[-1] > LONG_SECONDS:
                break
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()

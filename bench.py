"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores; names on the command line choose other queries.
"""

import json
import os
import platform
import sys
import tempfile
import time

from sangam.plans import catalogue, corpus
from sangam.session import local_session

HEADLINE = [
    "clean_text",
    "script_counts",
    "script_label",
    "parse_array_repr",
    "dedup_first",
    "cleaning_report",
    "unify_ids",
    "cleaned_corpus",
    "summary",
    "script_pivot",
    "conll_sentences",
    "array_csv_split_files",
    "id_only_files",
    "assign_splits",
    "final_dataset",
]


def dealt(spark, sf_dir: str, cpus: int) -> str:
    """A copy of the tables that the queries read, in several files each, as large tables come; not timed.

    The given files have one row group, which no reader can divide among cores.
    """
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in ("documents", "conversations"):
        whole = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        whole.repartition(2 * cpus).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    spark = local_session(cpus, shuffle_partitions=cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = dealt(spark, sf_dir, cpus)
    rows = corpus.document_lines(spark, sf_dir).count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        query = catalogue.QUERIES[name]
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best of two runs",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
                "input_rows": rows,
                "rows_per_sec": {n: round(rows / s) for n, s in seconds.items()},
                "cpus": cpus,
                "spark": spark.version,
                "python": platform.python_version(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

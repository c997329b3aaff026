"""Time the headline queries.

``BENCH_SF_DIR`` names the tables (sf0.1 by default), ``BENCH_CPUS`` the local cores, ``BENCH_RUNS``
the runs per query, of which the fastest counts; ``first`` has the first runs. The raw VCF and feature
rows are ingested to Parquet first, and the tables that one step hands to the next are built after that:
their times are reported as ``ingest`` and ``stages`` and left out of the sum.
"""

from __future__ import annotations

import json
import os
import re
import time

from varloom import catalog
from varloom.fixtures import Inputs
from varloom.session import build_session

HEADLINE = [
    "scan_vcf",
    "parse_info",
    "explode_ann",
    "split_annotations",
    "effect_counts",
    "qc_box_by_effect",
    "gene_annotations",
    "variants_in_genes",
    "site_list",
    "subset_sites",
    "site_allele_summary",
    "split_calls",
    "rank_variants",
    "cross_table",
    "cross_list",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = catalog.queries()
    started = time.perf_counter()
    inputs = Inputs(spark, sf_dir)
    inputs.vcf(), inputs.gff()
    ingest = time.perf_counter() - started
    stages = {}
    for name, build in (
        ("proteins_of_interest", catalog._stored_ids),
        ("gene_annotations", catalog._stored_genes),
        ("split_annotations", catalog._stored_split),
        ("site_list", catalog._stored_sites),
        ("ranked", catalog._stored_ranked),
    ):
        started = time.perf_counter()
        build(inputs)
        stages[name] = round(time.perf_counter() - started, 3)
    seconds, first = {}, {}
    for name in only.split(",") if only else HEADLINE:
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name], first[name] = round(min(taken), 3), round(taken[0], 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "ingest": round(ingest, 3),
                "stages": stages,
                "first": first,
            }
        )
    )


if __name__ == "__main__":
    main()

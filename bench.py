"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the threads, ``BENCH_RUNS`` the
runs per query, of which the fastest counts. With ``BENCH_COMPARE=1`` it also
times the same results computed naively: one action per audit figure, the
deduplication repeated for each, and joins without a broadcast.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.operators import cleaning, enrichment
from cauce.plans import run_all, run_clean, run_enrich
from cauce.schemas import KEY, LANDING
from cauce.shared import shared_dir, written
from checks.fixtures import dimensions, run_time, table
from checks.queries import QUERIES, src_clean_table, src_landing_table, stored_records

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Queries timed as registered, by a full run of their plan.
REGISTERED = [
    "src_rest_pages",
    "src_page_files",
    "src_csv",
    "src_json_array",
    "src_pipe_text",
    "src_xml",
    "src_html_table",
    "surrogate_id",
    "join_left_chain5",
    "join_left_shuffled",
    "agg_null_profile",
    "agg_duplicate_count",
    "agg_dedup_subset",
    "agg_step_removed",
    "agg_match_counts",
    "sort_by_event_date",
    "limit_sample",
    "report_ingest",
    "report_clean",
    "report_enrich",
    "job_profile",
    "job_clean",
    "job_enrich",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def lineitem_landing(spark: SparkSession) -> DataFrame:
    """A landing table of as many rows as ``lineitem``, a tenth of them copies of others."""
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    department = F.lpad((F.col("l_suppkey") % 30).cast("string"), 2, "0")
    events = table(spark, SF_DIR, "lineitem").select(
        line.alias("id"),
        F.when(line % 11 != 0, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias(
            "fecha_hecho"
        ),
        F.concat(F.lit(" "), department).alias("cod_depto"),
        F.concat(F.lit("nation_"), department).alias("departamento"),
        F.lpad(F.col("l_partkey").cast("string"), 5, "0").alias("cod_muni"),
        F.when(line % 17 != 0, F.concat("l_returnflag", F.lit(" "), "l_linestatus")).alias(
            "municipio"
        ),
        F.col("l_quantity").alias("cantidad"),
    )
    copies = events.filter(F.col("id") % 10 == 1).withColumn("id", F.col("id") + 10**12)
    landing = events.unionByName(copies).select(*LANDING.fieldNames())
    return written(landing, shared_dir(spark))


def naive_clean(landing: DataFrame, out: str) -> DataFrame:
    """Same figures and table: an action per figure, each repeating the deduplication."""
    keys = [c for c in landing.columns if c != "id"]
    landing.count()
    cleaning.null_profile(landing).collect()
    landing.dropDuplicates(keys).count()
    distinct = landing.dropDuplicates(keys)
    distinct.count()
    distinct.count()
    cleaned = cleaning.normalise(cleaning.drop_undated(distinct))
    cleaned.count()
    cleaned.count()
    cleaned.write.mode("overwrite").parquet(f"{out}/clean")
    return landing.sparkSession.read.parquet(f"{out}/clean")


def naive_enrich(clean: DataFrame, dims, out: str) -> None:
    """Same figures and table: shuffle joins, and an action per figure that repeats them."""
    joined = enrichment.with_key(clean)
    for dim in dims:
        dim.table.count()
        joined = joined.join(dim.table.hint("merge"), KEY, "left")
    joined = enrichment.with_rate(joined)
    joined.count()
    for dim in dims:
        joined.filter(F.col(dim.marker).isNotNull()).count()
    joined.write.mode("overwrite").parquet(f"{out}/enriched")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    dims = dimensions(spark, SF_DIR)
    landing, clean = src_landing_table(spark, SF_DIR), src_clean_table(spark, SF_DIR)
    big = lineitem_landing(spark)
    big_clean = written(cleaning.clean(big), shared_dir(spark))
    out = shared_dir(spark)

    timed = {name: lambda n=name: run(QUERIES[n](spark, SF_DIR)) for name in REGISTERED}
    timed |= {
        "run_clean": lambda: run_clean(landing, out, run_time(), "events"),
        "run_enrich": lambda: run_enrich(clean, dims, out, run_time()),
        "job_end_to_end": lambda: run_all(
            stored_records(spark, SF_DIR),
            dims,
            out,
            run_time(),
            "events",
            stored_records(spark, SF_DIR, first=1000),
        ),
        "run_clean_lineitem": lambda: run_clean(big, out, run_time(), "lineitem"),
        "run_enrich_lineitem": lambda: run_enrich(big_clean, dims, out, run_time()),
    }
    if os.environ.get("BENCH_COMPARE") == "1":
        timed |= {
            "naive_clean": lambda: naive_clean(landing, out),
            "naive_enrich": lambda: naive_enrich(clean, dims, out),
            "naive_clean_lineitem": lambda: naive_clean(big, out),
            "naive_enrich_lineitem": lambda: naive_enrich(big_clean, dims, out),
        }

    seconds = {}
    for name, action in timed.items():
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            action()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    total = round(sum(s for n, s in seconds.items() if not n.startswith("naive_")), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "rows": {"events_landing": landing.count(), "lineitem_landing": big.count()},
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Run one scheduled batch: ``python -m usagetally`` (or via ``spark-submit``).

    python -m usagetally --state S --log L --users U --facts F [--dim D]
        [--usage P] [--user-usage Q] [--jobs all|facts,summary,usage,user_usage]
        [--fact-mode full|left|new_only] [--start YYYYMMDD --end YYYYMMDD]
        [--summary T] [--manifest-buckets N [--summary-buckets M]]
        [--products 11036,-103000,...] [--reprocess] [--bucketed-view V --buckets N]

Without ``--start/--end`` the window comes from the state table (the day
after the processed end up to yesterday or the stop date).  The session
comes from ``spark-submit`` / the environment; nothing here picks a master.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from usagetally.plans.facts import FactJobConfig
from usagetally.plans.jobs import run_batch
from usagetally.plans.usage import UsageJobConfig
from usagetally.plans.window import JOB_ID
from usagetally.schemas import USAGE_PRODUCTS


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="usagetally", description="Run one batch of the usage-log jobs.")
    p.add_argument("--state", required=True, help="versioned state table root")
    p.add_argument("--log", required=True, help="usage log (Parquet, day column mday)")
    p.add_argument("--users", help="user dimension (Parquet)")
    p.add_argument("--facts", help="project fact table root")
    p.add_argument("--dim", help="project dimension table")
    p.add_argument("--summary", help="project summary table root")
    p.add_argument("--manifest-buckets", type=int, default=0, help="facts as a manifest table of so many key buckets")
    p.add_argument("--summary-buckets", type=int, default=0, help="with manifest buckets: summary kept up by signed deltas")
    p.add_argument("--usage", help="per-day project usage table")
    p.add_argument("--user-usage", help="per-day user usage table")
    p.add_argument("--jobs", default="all", help="all, or a comma list of facts,summary,usage,user_usage")
    p.add_argument("--fact-mode", default="full", choices=["full", "left", "new_only"])
    p.add_argument("--start", type=int)
    p.add_argument("--end", type=int)
    p.add_argument("--products", default=",".join(USAGE_PRODUCTS),
                   help="product codes of the usage jobs; empty = every product")
    p.add_argument("--fact-products", default="", help="product codes of the fact jobs; empty = every product")
    p.add_argument("--day-col", default="mday", help="int day column of the log")
    p.add_argument("--by-product", action="store_true", help="partition appended facts by product")
    p.add_argument("--bucketed-table", help="history table of the left and new_only modes")
    p.add_argument("--backslash-names", action="store_true", help="project names from backslash paths only")
    p.add_argument("--key-delimiter", default="")
    p.add_argument("--key-buckets", type=int, default=0, help="key buckets of the usage tables")
    p.add_argument("--extra-partitions", default="", help="comma list, e.g. pcode")
    p.add_argument("--job-id", default=JOB_ID, help="id of this job's rows in the state table")
    p.add_argument("--reprocess", action="store_true")
    p.add_argument("--bucketed-view")
    p.add_argument("--buckets", type=int, default=0)
    p.add_argument("--tiebreak", help="unique row id column of the log, if any")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> tuple[int, int]:
    a = parse(argv)
    spark = spark or SparkSession.builder.appName("usagetally").getOrCreate()
    products = tuple(x for x in a.products.split(",") if x)
    facts = FactJobConfig(log=a.log, users=a.users, facts=a.facts, dim=a.dim, tiebreak=a.tiebreak,
                          products=tuple(x for x in a.fact_products.split(",") if x), day_col=a.day_col,
                          by_product=a.by_product, bucketed_table=a.bucketed_table,
                          slash_rule=not a.backslash_names, key_delimiter=a.key_delimiter,
                          bucketed_view=a.bucketed_view, buckets=a.buckets, summary=a.summary,
                          manifest_buckets=a.manifest_buckets, summary_buckets=a.summary_buckets) if a.facts else None
    common = {"log": a.log, "products": products, "tiebreak": a.tiebreak, "day_col": a.day_col,
              "key_delimiter": a.key_delimiter, "key_buckets": a.key_buckets,
              "extra_partitions": tuple(x for x in a.extra_partitions.split(",") if x)}
    usage = UsageJobConfig(table=a.usage, **common) if a.usage else None
    user_usage = UsageJobConfig(table=a.user_usage, with_project=False, **common) if a.user_usage else None
    jobs = a.jobs if a.jobs == "all" else tuple(j.strip() for j in a.jobs.split(",") if j.strip())
    window = run_batch(spark, a.state, jobs, facts=facts, usage=usage, user_usage=user_usage,
                       start=a.start, end=a.end, reprocess=a.reprocess, fact_mode=a.fact_mode, job=a.job_id)
    print(f"processed window {window[0]}..{window[1]}")
    return window


if __name__ == "__main__":
    main()

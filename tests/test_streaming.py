from usagetally.plans.usage import UsageJobConfig
from usagetally.schemas import PROJECT_USAGE_SCHEMA
from usagetally.session import scratch_path
from usagetally.sources.fixtures import DAY_WINDOW, load_userlog_window
from usagetally.streaming import apply_batch

from .conftest import SF_SMALL


def test_replayed_batch_is_applied_once(spark):
    cfg = UsageJobConfig(log="unused", table=scratch_path(spark, "usage"), tiebreak="seq")
    work = scratch_path(spark, "stream")
    batch = load_userlog_window(spark, SF_SMALL, *DAY_WINDOW)
    apply_batch(cfg, work, batch, 0)
    first = spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)
    total = first.groupBy().sum("count").first()[0]
    apply_batch(cfg, work, batch, 0)          # a replay of the same micro-batch
    again = spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)
    assert again.groupBy().sum("count").first()[0] == total
    apply_batch(cfg, work, batch, 1)          # a new batch with the same rows adds them
    third = spark.read.schema(PROJECT_USAGE_SCHEMA).parquet(cfg.table)
    assert third.groupBy().sum("count").first()[0] == 2 * total

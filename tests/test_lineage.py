"""Written copies and session settings."""

from pathlib import Path

from pyspark.sql import functions as F

from ledgerline.operators.lineage import cut_lineage, shared_folder
from ledgerline.session import SETTINGS, build_session


def test_copy_lies_in_the_shared_folder_and_keeps_pruning(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "ledgerline"
    before = set(folder.glob("*"))
    df = spark.range(100).select("id", (F.col("id") * 2).alias("double"))
    kept = cut_lineage(df)
    assert len(set(folder.glob("*")) - before) == 1
    assert kept.dtypes == df.dtypes and kept.count() == 100
    plan = kept.where("id > 97").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,97)" in plan and "ReadSchema: struct<id:bigint>" in plan


class FakeSession:
    """Session with the given settings alone."""

    def __init__(self, **settings):
        self.conf, self.settings = self, {k.replace("__", "."): v for k, v in settings.items()}

    def get(self, key, default):
        return self.settings.get(key, default)


def test_without_the_setting_copies_lie_below_the_warehouse():
    warehouse = {"spark__sql__warehouse__dir": "hdfs://w/"}
    assert shared_folder(FakeSession(**warehouse)) == "hdfs://w/_work"
    assert shared_folder(FakeSession(spark__checkpoint__dir="hdfs://c", **warehouse)) == "hdfs://c"


def test_settings_of_the_submitter_win(spark):
    build_session("again")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value

"""One key with a third of all rows: results stay whole and the plan splits the key."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import contacts, ladders
from shelfmark.operators import dedupe, groups, ranking, rollup
from shelfmark.session import cut_lineage, shared_folder


@pytest.fixture
def skewed(spark):
    return spark.range(60000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"), (F.col("id") % 7).alias("v")
    )


def test_attach_group_splits_the_hot_key(spark, skewed):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        out = groups.attach_group(skewed, ["k"], {"n": F.count(F.lit(1)), "total": F.sum("v")})
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert len(rows) == 60000 and {r["n"] for r in rows if r["k"] == "hot"} == {20000}
    assert "skew=true" in plan


def test_hot_key_is_kept_whole(skewed):
    lists = groups.listed(skewed, ["k"], F.col("id"), F.col("id"))
    assert lists.filter("k = 'hot'").agg(F.count("value"), F.max("position"), F.countDistinct("position")).first()[:] == (20000, 20000, 20000)
    assert lists.count() == 60000
    assert dedupe.dedup_exact(skewed, ["k"], [F.col("id")]).count() == skewed.select("k").distinct().count()
    counted = rollup.value_counts(skewed, "k").first()
    assert tuple(counted) == ("hot", 20000)


def test_streaks_of_a_hot_group_are_chunked(skewed):
    out = ranking.miss_streak_stop(skewed, "k", "id", F.col("v") != 100, 50, width=500)
    assert out.filter("k = 'hot' AND NOT skipped").count() == 50


def test_cut_lineage_writes_to_the_shared_folder(spark):
    df = cut_lineage(spark.range(5).withColumn("s", F.lit("x")))
    assert df.count() == 5
    assert shared_folder(spark).split(":")[-1] in df.inputFiles()[0]
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")


def test_row_ledger_counts_without_a_pass(spark):
    df, seen = rollup.row_ledger(spark.range(12), "load")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 12


def test_small_rules(spark):
    row = spark.range(1).select(
        ladders.promote_status(F.lit("NEED CONTACT"), F.lit(45), F.lit(True)).alias("a"),
        ladders.author_signal(F.lit("A New York Times bestselling author")).alias("b"),
        contacts.contact_confidence(F.lit(""), F.lit(""), F.lit("a@b.net"), F.lit("x")).alias("c"),
        contacts.has_contact_signal(F.lit("nan"), F.lit("x")).alias("d"),
    ).first()
    assert tuple(row) == ("READY", "Known / commercially proven", "Medium", True)

"""The bucketed store: same rows as the plain one, no exchange of the store, fewer rows read for single ids."""

import re

from pyspark.sql import functions as F

from folio.operators import store as S
from folio.session import scratch_path

SCHEMA = "_id string, _needs_download boolean, version_hash string, source_page_url string, row_pos int, doc_name string"


def records(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.sha2((F.col("id") % 700).cast("string"), 256).alias("version_hash"), F.concat(F.lit("p"), F.col("id") % 13).alias("source_page_url"),
        (F.col("id") % 50).cast("int").alias("row_pos"), F.col("id").cast("string").alias("doc_name"))


def new_table(spark, buckets=6):
    path = scratch_path(spark, "bucketed-test")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    S.open_bucketed(spark, name, path, SCHEMA, buckets)
    return name, path


def key(df):
    return sorted((r._id, r.source_page_url, r.row_pos) for r in df.select("_id", "source_page_url", "row_pos").collect())


def test_same_rows_as_the_plain_store(spark):
    name, path = new_table(spark)
    plain = scratch_path(spark, "plain-test")
    for batch in (records(spark, 500), records(spark, 900, 300), records(spark, 900, 300)):
        assert S.insert_bucketed(spark, batch, name) == S.insert_if_absent(spark, batch, plain)
    assert key(spark.table(name)) == key(S.read_store(spark, plain))
    again = name + "_again"  # another session finds the same store by its folder
    assert key(S.open_bucketed(spark, again, path, SCHEMA, 6)) == key(spark.table(name))
    assert S.insert_bucketed(spark, records(spark, 900), again) == 0
    S.drop_store(spark, name)
    assert not spark.catalog.tableExists(name)


def test_store_side_has_no_exchange(spark):
    name, _ = new_table(spark)
    S.insert_bucketed(spark, records(spark, 500), name)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        plan = S.new_in_bucketed(spark, records(spark, 900), name)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "LeftAnti" in plan and "Bucketed: true" in plan
    assert len(re.findall(r"Exchange", plan)) == 1  # the batch, dealt once for both the window and the join
    assert "Exchange" not in plan[plan.index("Bucketed: true") - 600:plan.index("Bucketed: true")].split("LeftAnti")[-1]


def test_single_ids_skip_row_groups(spark):
    name, path = new_table(spark, buckets=4)
    S.insert_bucketed(spark, spark.range(40000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("version_hash"), F.lit("p").alias("source_page_url"),
        F.lit(0).alias("row_pos"), F.col("id").cast("string").alias("doc_name")), name)
    wanted = [r._id for r in spark.table(name).orderBy(F.xxhash64("_id")).limit(3).collect()]

    def scanned(df):
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        leaf = node.collectLeaves().head()
        while leaf.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ResultQueryStageExec", "ShuffleQueryStageExec"):
            leaf = leaf.executedPlan().collectLeaves().head() if "Adaptive" in leaf.getClass().getSimpleName() else leaf.plan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()

    found = S.find_ids(spark.table(name), wanted)
    assert sorted(r._id for r in found.collect()) == sorted(wanted)
    missing = S.find_ids(spark.table(name), ["f" * 63 + "g"])
    assert scanned(missing) < 40000
    assert missing.count() == 0

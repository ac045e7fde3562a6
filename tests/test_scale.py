"""Plans and skew: what must hold for the work to spread over many executors."""

import contextlib

from pyspark.sql import functions as F

from tamarack.operators import intervals, keys, quantiles, ranks
from tamarack.operators.joins import attach
from tamarack.session import shared_folder
from __spark_entry__ import queries

QUERIES = queries()
FOLDER = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{key.replace('__', '.')}": value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split(spark):
    """One key holds a third of the rows; both sides are too large to broadcast."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"), F.repeat(F.lit("x"), 40).alias("pad"), "id"
    )
    labels = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.col("id").cast("string").alias("label"))
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="16",
        adaptive__skewJoin__skewedPartitionFactor="1.5", adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        adaptive__advisoryPartitionSizeInBytes="20000",
    ):
        joined = keys.attach_labels(rows, labels, ["k"])
        assert joined.agg(F.count("label"), F.count_distinct("id")).first()[:] == (60_000, 60_000)
        collected = joined.select("id", "label")
        collected.collect()
        assert "skew=true" in plan(collected)


def test_first_per_key_limits_before_the_shuffle(spark):
    text = plan(keys.first_per_key(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], [F.col("id")]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_settled_labels_shuffle_once(spark):
    rows = spark.range(10).selectExpr("id % 3 as k", "string(id) as label", "id > 2 as ok", "string(id) as allele", "id as src_ord")
    assert plan(keys.settled_labels(rows, ["k"], "label", "ok", "allele", ["src_ord"])).count("Exchange hashpartitioning") == 1


def test_scans_are_pruned(spark):
    text = QUERIES["panel_scan"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(p_brand" in text or "In(p_brand" in text
    assert "l_comment" not in text and "l_extendedprice" not in text


def test_no_query_plan_has_a_nested_loop(spark):
    for name in ["panel_scan", "gold_build", "annotated_rows", "score_lookup", "liftover", "chained_scores", "external_scores",
                 "without_ambiguous_keys", "crosswalk_join", "unlabelled_pool", "grid_to_pairs"]:
        text = plan(QUERIES[name](spark, FOLDER))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_no_window_spans_a_whole_class_or_column(spark):
    rows = spark.range(1000).withColumn("label", F.lit("one class")).withColumn("v", F.col("id").cast("double"))
    for df in (ranks.stratified_folds(rows, "id", "label"), ranks.average_ranks(rows, "v")):
        lines = [line for line in plan(df).splitlines() if "Window [" in line and "_total" not in line]
        assert lines and all("bucket" in line for line in lines)


def test_null_keys_spread_over_all_tasks(spark):
    """Nine in ten rows have no key, some of those alike; without adaptive execution and broadcasts."""
    rows = spark.range(40_000, numPartitions=5).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.when(F.col("id") % 20 == 0, F.lit("x")).alias("chrom"), (F.col("id") % 400).alias("other"),
        F.create_map(F.lit("a"), "id").alias("m"),
    )
    table = spark.range(0, 40_000, 30).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("v"))
    places = spark.range(0, 40_000, 60).select(F.lit("x").alias("chrom"), F.col("id").alias("position"), F.lit(1.0).alias("score"))
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions="8"):
        for found, hits in ((keys.lookup(rows, table, "k", "key"), 40_000 // 30 + 1), (intervals.attach(rows, places, "chrom", "k"), 40_000 // 60 + 1)):
            value = found.columns[-1]
            sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 40_000 and len(sizes) == 8 and max(sizes) < 1.5 * 40_000 / 8
            row = found.agg(F.count(value), F.count(F.when(F.col("k").isNull(), F.col(value)))).first()
            assert tuple(row) == (hits, 0)
            assert found.columns == [*rows.columns, value]


def test_rows_of_a_hot_key_spread_over_all_tasks(spark):
    """The facts of hot keys are broadcast; their rows then spread by their own values."""
    rows = spark.range(40_000, numPartitions=5).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v"))
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions="8"):
        found = attach(rows, facts, "k", "n", 40_000, "id")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("v").alias("count")).collect()]
        assert sum(sizes) == 40_000 and len(sizes) == 8 and max(sizes) < 1.2 * 40_000 / 8
        assert found.join(facts.select("k", F.col("v").alias("w")), "k").filter("v = w").count() == 40_000


def test_quantiles_order_a_few_rows_of_a_column(spark):
    rows = spark.range(400_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("v"))
    low, high = rows.agg(F.percentile_approx("v", list(quantiles.window_shares(0.5, quantiles.ACCURACY)), quantiles.ACCURACY).alias("e")).first().e
    assert 0 < rows.filter(F.col("v").between(low, high)).count() < 400
    assert quantiles.exact_quantiles(rows, "v", [0.5]).first().q == [rows.agg(F.median("v")).first()[0]]


def test_the_cluster_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

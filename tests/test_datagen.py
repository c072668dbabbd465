from pyspark.sql import functions as F

from riskstream.config import GeneratorConfig
from riskstream.operators import datagen


def made(spark, n=4000, parts=4, **kw):
    return datagen.transactions(spark.range(0, n, 1, parts), **kw)


def test_same_rows_for_any_partitioning(spark):
    for build in (datagen.transactions, datagen.training_rows):
        one = build(spark.range(0, 500, 1, 1))
        many = build(spark.range(0, 500, 1, 7))
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_seed_changes_rows(spark):
    assert made(spark, 50, seed=1).collect() != made(spark, 50, seed=2).collect()


def test_ids_are_distinct_version_4(spark):
    ids = made(spark).select("transaction_id")
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}$"
    assert ids.where(~F.col("transaction_id").rlike(shape)).isEmpty()
    assert ids.distinct().count() == ids.count()


def test_distributions(spark):
    rows = made(spark, 20000)
    stats = rows.agg(
        F.avg((F.col("amount") > 500).cast("int")).alias("suspicious"),
        F.avg((F.col("location") == "FOREIGN_REMOTE").cast("int")).alias("remote"),
        F.avg(F.col("is_online").cast("int")).alias("online"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        F.countDistinct("payment_method").alias("methods"),
        F.countDistinct("merchant_category").alias("categories"),
        F.countDistinct("location").alias("places"),
    ).first()
    assert abs(stats.suspicious - 0.05) < 0.005
    assert abs(stats.remote - 0.025) < 0.004
    assert abs(stats.online - 0.5) < 0.02
    assert 5.0 <= stats.low and stats.high <= 10000.0
    assert (stats.methods, stats.categories, stats.places) == (4, 6, 5)
    gap = rows.where((F.col("amount") > 500) & (F.col("amount") < 2000))
    assert gap.isEmpty()


def test_bursts(spark):
    plan = datagen.with_bursts(spark.range(20000))
    bursts = plan.where("burst_user IS NOT NULL").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("burst_user", "burst_device", "burst_location").alias("kinds"),
    )
    stats = bursts.agg(F.min("n"), F.max("n"), F.max("kinds"), F.count(F.lit(1))).first()
    assert tuple(stats)[:3] == (5, 12, 1)
    assert abs(stats[3] / 20000 - 0.1) < 0.01
    lone = plan.where("burst_user IS NULL")
    assert lone.where("step <> 0").isEmpty()


def test_burst_rows_share_user_and_device_a_tenth_apart(spark):
    rows = made(spark, 2000).where("user_id LIKE 'VOL_%'").withColumn(
        "at", F.unix_micros(F.col("timestamp").cast("timestamp"))
    )
    spans = rows.groupBy("user_id", "device_id").agg(
        F.count(F.lit(1)).alias("n"), (F.max("at") - F.min("at")).alias("span")
    )
    for row in spans.where("n BETWEEN 5 AND 12").collect():
        assert row.span == (row.n - 1) * 100_000
    assert rows.where(~F.col("device_id").startswith("DEV_BOT_")).isEmpty()


def test_settings_are_used(spark):
    config = GeneratorConfig(interval=2.0, burst_probability=0.0, locations=("Bizerte",))
    rows = made(spark, 100, config=config)
    assert rows.count() == 100
    assert {r.location for r in rows.select("location").collect()} <= {"Bizerte", "FOREIGN_REMOTE"}
    last = rows.agg(F.max("timestamp")).first()[0]
    assert last == "2026-01-01T00:03:18.000000"


def test_training_label_is_two_of_three(spark):
    rows = datagen.training_rows(spark.range(20000))
    conditions = (
        (F.col("amount") > 5000).cast("int")
        + ((F.col("tx_hour") < 6) | (F.col("tx_hour") > 22)).cast("int")
        + (F.col("location") == "FOREIGN_REMOTE").cast("int")
    )
    assert rows.where((conditions >= 2).cast("int") != F.col("label")).isEmpty()
    assert abs(rows.agg(F.avg("label")).first()[0] - 0.271) < 0.015
    hours = rows.agg(F.min("tx_hour"), F.max("tx_hour")).first()
    assert tuple(hours) == (0, 23)

import random
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from riskstream.operators import dedup, velocity

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)


def frame(spark, rows):
    """Rows of (user, seconds, amount)."""
    data = [
        (str(i), user, BASE + timedelta(seconds=s), float(amount))
        for i, (user, s, amount) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data, "transaction_id string, user_id string, ts timestamp, amount double"
    )


@pytest.fixture(scope="module")
def skewed():
    """One user holds a third of the rows; many rows share an instant."""
    rng = random.Random(7)
    hot = [("hot", rng.randrange(0, 200_000), rng.randrange(1, 100)) for _ in range(700)]
    rest = [
        (f"u{rng.randrange(40)}", rng.randrange(0, 200_000), rng.randrange(1, 100))
        for _ in range(1300)
    ]
    unkeyed = [(None, rng.randrange(0, 100_000), 1) for _ in range(100)]
    tied = unkeyed + [("hot", 50_000, 1)] * 50 + [("hot", 50_000 + 6 * 3600, 1)] * 5
    return hot + rest + tied


def test_trailing_against_brute_force(spark, skewed):
    by_user = defaultdict(list)
    for user, s, amount in skewed:
        by_user[user].append((s, amount))
    expected = {}
    for i, (user, s, _) in enumerate(skewed):
        held = [a for t, a in by_user[user] if s - 6 * 3600 <= t <= s]
        expected[str(i)] = (len(held), sum(held) / len(held))
    found = velocity.trailing(frame(spark, skewed)).collect()
    assert len(found) == len(skewed)
    for row in found:
        n, mean = expected[row.transaction_id]
        assert row.n == n
        assert row.mean_amount == pytest.approx(mean, abs=0.0051)


def test_rows_without_a_time(spark):
    rows = frame(spark, [("a", 0, 2), ("a", 60, 4), ("a", 120, 9)]).withColumn(
        "ts", F.when(F.col("transaction_id") != "2", F.col("ts"))
    )
    found = {r.transaction_id: r for r in velocity.trailing(rows).collect()}
    assert {k: (r.n, r.mean_amount) for k, r in found.items()} == {
        "0": (1, 2.0), "1": (2, 3.0), "2": (0, None),
    }
    assert [r.n for r in velocity.sessions(rows).collect()] == [2]
    assert {r.n for r in velocity.sliding(rows, 24 * 3600, 3600).collect()} == {2}
    profiled = {r.transaction_id: r.user_n for r in velocity.with_profile(rows).collect()}
    assert profiled == {"0": 2, "1": 2, "2": None}


def test_trailing_before_the_epoch(spark):
    rows = frame(spark, [("a", -2_000_000_000, 1), ("a", -2_000_000_000 + 60, 3)])
    found = sorted(tuple(r)[3:] for r in velocity.trailing(rows, 3600).collect())
    assert found == [(1, 1.0), (2, 2.0)]


@pytest.mark.parametrize("overlap", [1, 3, 12])
def test_sliding_against_brute_force(spark, skewed, overlap):
    expected = defaultdict(int)
    for user, s, _ in skewed:
        pane = s // 7200 * 7200
        for k in range(overlap):
            expected[user, pane - k * 7200] += 1
    found = velocity.sliding(frame(spark, skewed), overlap * 7200, 7200).withColumn(
        "start", F.unix_micros("window_start")
    )
    base = int(BASE.timestamp())
    got = {(r.user_id, r.start // 1_000_000 - base): r.n for r in found.collect()}
    assert got == expected


def test_uneven_slide(spark, skewed):
    rows = frame(spark, skewed)
    found = velocity.sliding(rows, 5 * 3600, 2 * 3600)
    window = rows.groupBy(F.window("ts", "5 hours", "2 hours").alias("w"), "user_id").count()
    own = window.select("w.start", "user_id", "count")
    assert found.exceptAll(own).isEmpty() and own.exceptAll(found).isEmpty()


def test_sessions_against_spark_and_at_the_exact_gap(spark, skewed):
    rows = frame(spark, skewed + [("edge", 0, 1), ("edge", 600, 1), ("edge", 1201, 1)])
    for gap in (600, 3600):
        ours = velocity.sessions(rows, gap)
        spark_own = rows.groupBy(
            F.session_window("ts", f"{gap} seconds").alias("w"), "user_id"
        ).count().select("w.start", "user_id", "count")
        assert ours.exceptAll(spark_own).isEmpty() and spark_own.exceptAll(ours).isEmpty()
    edge = velocity.sessions(rows.where("user_id = 'edge'"), 600)
    assert sorted(r.n for r in edge.collect()) == [1, 2]


def test_bursts_of_generated_traffic(spark):
    from riskstream.operators import datagen

    made = datagen.transactions(spark.range(300)).withColumn(
        "ts", F.col("timestamp").cast("timestamp")
    )
    flagged = velocity.bursts(velocity.trailing(made, seconds=10), 5)
    users = {r.user_id for r in flagged.collect()}
    expected = {
        r.user_id
        for r in made.where("user_id LIKE 'VOL_%'").groupBy("user_id").count().collect()
    }
    assert users == expected


def test_no_group_of_the_trailing_window_grows_with_a_user(spark):
    """Half of all rows from no user in one instant's neighbourhood, half of those timeless."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("u"), F.col("id"))).alias("user_id"),
        F.when(F.col("id") % 4 != 1, F.timestamp_micros(F.col("id") * 100)).alias("ts"),
        F.lit(1.0).alias("amount"),
    )
    found = velocity.trailing(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for line in re.findall(r"Window \[.*", plan):
        assert "hour" in line
    # Twice as many before: instants, hours and rows are shuffled, each once.
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan.split("Initial Plan")[0])) <= 8
    assert found.where("user_id is null and ts is null and n = 0").count() == 10_000
    assert found.where("user_id is null").agg(F.max("n")).first()[0] == 10_000
    assert found.count() == 40_000


def test_sums_of_money_stay_exact(spark):
    rows = spark.range(0, 20_000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("a").alias("user_id"),
        F.timestamp_micros(F.col("id")).alias("ts"), F.lit(1e9).alias("amount"),
    )
    assert velocity.tumbling(rows).first().total == 2e13
    last = velocity.trailing(rows).orderBy(F.desc("n")).first()
    assert (last.n, last.mean_amount) == (20_000, 1e9)


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), -float("inf"), 1e30])
def test_a_sum_with_no_exact_value_is_null(spark, amount):
    rows = frame(spark, [("a", 0, 1), ("a", 60, amount), ("a", 7 * 3600, 2), ("b", 0, 1e13)])
    totals = {(r.user_id, r.window_start.hour): r.total for r in velocity.tumbling(rows).collect()}
    assert sorted(totals.values(), key=str) == [1e13, 2.0, None]
    means = {r.transaction_id: r.mean_amount for r in velocity.trailing(rows).collect()}
    assert means == {"0": 1.0, "1": None, "2": 2.0, "3": 1e13}


def test_profile_joins_every_row(spark, skewed):
    sums = defaultdict(lambda: [0, 0])
    for user, s, amount in skewed:
        entry = sums[user, s // 21600]
        entry[0] += 1
        entry[1] += amount
    found = velocity.with_profile(frame(spark, skewed)).collect()
    assert len(found) == len(skewed)
    for row in found:
        user, s, _ = skewed[int(row.transaction_id)]
        expected = sums[user, s // 21600] if user else [None, None]
        assert [row.user_n, row.user_total] == expected


def test_busy_window_is_split(spark):
    ids = spark.range(0, 200_000, 1, 8)
    rows = ids.select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.timestamp_micros(F.col("id") * 1000).alias("ts"),
        F.lit(1.0).alias("amount"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        profiled = velocity.with_profile(rows)
        hot = profiled.where("user_id = 'hot'").agg(F.min("user_n"), F.max("user_n")).first()
        assert tuple(hot) == (66_667, 66_667)
        assert len(profiled.collect()) == 200_000
        plan = profiled._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_first_copies_keep_the_earliest(spark):
    rows = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only"), ("a", 1, "zz")],
        "id string, at int, what string",
    )
    kept = dedup.first_copies(rows, "id", ["at"])
    assert sorted(map(tuple, kept.collect())) == [("a", 1, "early"), ("b", 1, "only")]


def test_rows_without_a_key_are_no_copies(spark):
    rows = spark.createDataFrame(
        [(None, 1, "x"), (None, 1, "x"), (None, 2, "y"), ("a", 1, "z"), ("a", 2, "z")],
        "id string, at int, what string",
    )
    kept = dedup.first_copies(rows, "id", ["at"])
    assert sorted(map(tuple, kept.collect()), key=str) == [
        ("a", 1, "z"), (None, 1, "x"), (None, 1, "x"), (None, 2, "y"),
    ]

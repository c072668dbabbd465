"""The driver's queries: every operator over the whole ``events`` table.

Each takes a session and a table folder and returns a lazy frame, except where
the operator itself runs a job (a fit, an evaluation, a stream).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.config import Policy
from riskstream.functions import labels
from riskstream.operators import alerts, datagen, decode, dedup, model, scoring, velocity
from riskstream.plans import scoring as plans
from riskstream.plans import training
from riskstream.session import pin_zone, shared_folder
from riskstream.sources import events
from riskstream.sources.tables import scored_table
from riskstream.streaming import alerts as alert_stream
from riskstream.streaming import bursts as burst_stream
from riskstream.streaming import late as late_stream
from riskstream.streaming import scoring as scoring_stream
from riskstream.streaming.committed import CommittedTable
from riskstream.streaming.profiles import Profiles
from riskstream.streaming.sinks import BatchRef, files
from riskstream.streaming.stored import StoredIds

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _wall_clock(column: str) -> Column:
    """A TIMESTAMP as the same reading without a zone, as other engines keep it."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def _tx(spark: SparkSession, folder: str) -> DataFrame:
    return events.transactions(spark, folder)


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.transaction_messages(_tx(spark, folder))


def _featured(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.with_features(_tx(spark, folder))


def _with_stand_in(spark: SparkSession, folder: str) -> DataFrame:
    return _featured(spark, folder).withColumn(
        "fraud_probability", events.stand_in_probability()
    )


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.decide(_with_stand_in(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score(_tx(spark, folder), model.pinned(spark))


def _fields(messages: DataFrame, declared) -> DataFrame:
    """A message's key and the fields of its payload."""
    record = F.from_json("value", declared)
    return messages.select("key", record.alias("record")).select("key", "record.*")


# Decode and messages


@_query
def tx_decode(spark, folder):
    return decode.decode_transactions(_messages(spark, folder))


@_query
def tx_features(spark, folder):
    featured = scoring.with_features(decode.decode_transactions(_messages(spark, folder)))
    return featured.select("transaction_id", "is_online", _wall_clock("tx_timestamp"), "tx_hour")


@_query
def tx_messages(spark, folder):
    return _fields(_messages(spark, folder), schema.TRANSACTION)


@_query
def ordered_messages(spark, folder):
    """Published by user and time: for each user its messages, and whether they ascend in
    every file written."""
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    sent = alerts.transaction_messages(alerts.by_user_and_time(_tx(spark, folder), "ts"))
    sent.write.parquet(f"{root}/messages")
    read = spark.read.schema(schema.MESSAGE).parquet(f"{root}/messages").select(
        "key", F.get_json_object("value", "$.timestamp").alias("at"),
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place"),
    )
    before = F.lag("at").over(Window.partitionBy("file", "key").orderBy("place"))
    marked = read.withColumn("ascends", F.coalesce(before <= F.col("at"), F.lit(True)))
    return marked.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("ascends").alias("ascends")
    )


@_query
def scored_messages(spark, folder):
    decoded = _fields(alerts.scored_messages(_decided(spark, folder)), schema.SCORED)
    return decoded.withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def alert_messages(spark, folder):
    frauds = plans.frauds(_messages(spark, folder), model.pinned(spark))
    return _fields(alerts.alert_messages(frauds), schema.ALERT)


def _damaged(transactions: DataFrame) -> DataFrame:
    """Messages of which most are unusable, each kind of damage in turn."""
    ident = F.concat(F.lit('"transaction_id":"'), F.col("event_id").cast("string"), F.lit('"'))
    online, time = F.lit(',"is_online":true'), F.lit(',"timestamp":"2024-01-01T00:00:00"')
    amount = F.lit(',"amount":12.5')

    def record(*parts):
        return F.concat(F.lit("{"), *parts, F.lit("}"))

    kinds = [
        record(ident, amount, online, time),
        F.concat(F.lit("not json "), F.col("event_id").cast("string")),
        F.lit(""),
        F.lit(None).cast("string"),
        record(ident, online, time),
        record(ident, F.lit(',"amount":"12.5"'), online, time),
        record(ident, F.lit(',"amount":1e400'), online, time),
        record(ident, F.lit(',"amount":NaN'), online, time),
        record(ident, amount, time),
        record(ident, amount, F.lit(',"is_online":1'), time),
        record(ident, amount, online),
        record(ident, amount, online, F.lit(',"timestamp":"bogus"')),
        F.concat(F.lit("["), record(ident, amount, online, time), F.lit("]")),
        record(F.lit('"AMOUNT":1.0'), online, time),
    ]
    kind = (F.col("event_id") % len(kinds)).cast("int")
    return transactions.select(F.element_at(F.array(*kinds), kind + 1).alias("value"))


@_query
def quarantine(spark, folder):
    return decode.quarantine(_damaged(_tx(spark, folder)))


# Decision


@_query
def rule_score(spark, folder):
    return scoring.with_rules(_featured(spark, folder)).select("event_id", "rule_score")


@_query
def final_score(spark, folder):
    ruled = scoring.with_rules(_with_stand_in(spark, folder))
    return scoring.with_final_score(ruled).select("event_id", "final_fraud_score")


@_query
def risk_level(spark, folder):
    return _decided(spark, folder).select("event_id", "risk_level")


@_query
def classify(spark, folder):
    return _decided(spark, folder).select("event_id", "prediction")


@_query
def reason(spark, folder):
    return _decided(spark, folder).select("event_id", "prediction", "reason")


@_query
def scored_policy(spark, folder):
    """Another weight of the model and another threshold."""
    policy = Policy(ml_weight=0.7, fraud_threshold=0.8)
    decided = scoring.decide(_with_stand_in(spark, folder), policy)
    return decided.select("event_id", "final_fraud_score", "risk_level", "prediction", "reason")


# Forest and whole chains


@_query
def forest_probability(spark, folder):
    scored = scoring.with_probability(_featured(spark, folder), model.pinned(spark))
    return scored.select("event_id", "fraud_probability")


@_query
def scored_full(spark, folder):
    rows = plans.scored(_messages(spark, folder), model.pinned(spark))
    return rows.withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def fraud_alerts(spark, folder):
    frauds = plans.frauds(_messages(spark, folder), model.pinned(spark))
    return frauds.select(schema.ALERT_FIELDS)


@_query
def batch_summary(spark, folder):
    return alerts.batch_summary(_scored(spark, folder))


@_query
def top_risk(spark, folder):
    return alerts.preview(_scored(spark, folder))


@_query
def alert_text(spark, folder):
    frauds = plans.frauds(_messages(spark, folder), model.pinned(spark))
    feed = alert_stream.read_alerts(alerts.alert_messages(frauds))
    return feed.select("transaction_id", "alert_text", "warning")


# Training


@_query
def category_index(spark, folder):
    return model.category_index(_tx(spark, folder))


@_query
def category_unseen(spark, folder):
    """The shipped indexer over rows whose categories it knows, has not seen, or lacks."""
    third = F.col("event_id") % 3
    rows = _tx(spark, folder).select(
        "event_id",
        *[
            F.when(third == 1, F.concat(F.lit("NEW_"), F.col(c))).when(third == 0, F.col(c)).alias(c)
            for c in schema.CATEGORY_INPUTS
        ],
    )
    indexed = model.pinned(spark).stages[0].transform(rows)
    return indexed.select("event_id", *model.CATEGORY_INDEXES)


@_query
def feature_vector(spark, folder):
    indexer, assembler = model.pinned(spark).stages[:2]
    vectors = assembler.transform(indexer.transform(_featured(spark, folder)))
    listed = vectors.select("event_id", vector_to_array("features").alias("f"))
    return listed.select("event_id", *[F.col("f")[i].alias(f"f{i}") for i in range(5)])


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    score = labels.training_score(
        *(F.col(c) for c in ("amount", "tx_hour", "location")), events.stand_in_probability()
    )
    return _featured(spark, folder).withColumn("fraud_prob", score).withColumn(
        "label", labels.training_label(F.col("fraud_prob"))
    )


@_query
def training_label(spark, folder):
    return _labelled(spark, folder).select("event_id", "fraud_prob", "label")


@_query
def relabel(spark, folder):
    return model.relabelled(_scored(spark, folder))


@_query
def retrain(spark, folder):
    """Stored scores to a new model, saved and loaded: what went in, and whether it scores alike."""
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    scored = _scored(spark, folder).select(schema.SCORED_FIELDS)
    scored.write.parquet(f"{root}/scored/run=a/batch_id=0")
    fitted, _ = training.run(spark, f"{root}/scored", f"{root}/model")
    rows = model.with_split(
        model.relabelled(scored_table(spark, f"{root}/scored")), "transaction_id"
    )

    def chance(by, name, *more):
        found = by.transform(rows.withColumnRenamed("label", "relabelled"))
        return found.select("transaction_id", vector_to_array("probability")[1].alias(name), *more)

    loaded = chance(model.load(f"{root}/model"), "q")
    both = chance(fitted, "p", "relabelled", "is_train").join(loaded, "transaction_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("relabelled").cast("bigint").alias("positive"),
        F.avg(F.col("is_train").cast("int")).between(0.7, 0.9).alias("split_holds"),
        F.count(F.when(F.col("p") == F.col("q"), 1)).alias("n_alike"),
    )


@_query
def holdout_split(spark, folder):
    split = model.with_split(_tx(spark, folder), "event_id")
    return split.select("event_id", "bucket", "is_train")


@_query
def auc(spark, folder):
    judged = scoring.with_probability(_labelled(spark, folder), model.pinned(spark))
    area = model.area_under_roc(judged.select("fraud_probability", "label"), "fraud_probability")
    return spark.createDataFrame([(round(area, 9),)], "auc double")


@_query
def fit_and_judge(spark, folder):
    """Fit on the whole table's training side; what another engine can say of the fit.

    The area itself depends on how the forest draws its samples; that it is the area of
    the model's own holdout scores does not.
    """
    rows = _labelled(spark, folder)
    fitted, area = model.fit(rows, "event_id")
    split = model.with_split(rows, "event_id")
    held = fitted.transform(split.where("not is_train").select(*schema.MODEL_INPUTS, "label"))
    by_ranks = model.rank_sum_area(held, vector_to_array("rawPrediction")[1])
    train = F.col("is_train")
    return split.agg(
        F.count(F.when(train, 1)).alias("n_train"), F.count(F.when(~train, 1)).alias("n_holdout"),
        F.sum(F.when(train, F.col("label"))).cast("bigint").alias("positive_train"),
        F.sum(F.when(~train, F.col("label"))).cast("bigint").alias("positive_holdout"),
    ).select(
        "*",
        F.lit(",".join(fitted.stages[0].labelsArray[0])).alias("locations"),
        F.lit(abs(by_ranks - area) < 1e-9).alias("area_agrees"),
    )


# Velocity


@_query
def velocity_tumbling(spark, folder):
    windows = velocity.tumbling(_tx(spark, folder))
    return windows.withColumn("window_start", _wall_clock("window_start"))


@_query
def user_profile(spark, folder):
    profiled = velocity.with_profile(_tx(spark, folder))
    return profiled.select("event_id", "user_id", "user_n", "user_total")


@_query
def velocity_sliding(spark, folder):
    windows = velocity.sliding(_tx(spark, folder))
    return windows.withColumn("window_start", _wall_clock("window_start"))


@_query
def velocity_uneven(spark, folder):
    """Windows of five hours every two: panes of one hour."""
    windows = velocity.sliding(_tx(spark, folder), 5 * velocity.HOUR, 2 * velocity.HOUR)
    return windows.withColumn("window_start", _wall_clock("window_start"))


def _odd_money(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts past what 64 bits hold in millionths, some beyond any sum or no number."""
    kind = F.col("event_id") % 100
    amount = (
        F.when(kind == 0, F.lit(float("nan")))
        .when(kind == 1, F.lit(float("inf")))
        .when(kind == 2, F.lit(1e25))
        .otherwise(F.col("amount") * F.lit(float(1 << 40)))
    )
    return _tx(spark, folder).withColumn("amount", amount)


def _millions(column: str) -> Column:
    return F.round(F.col(column) / F.lit(1e6)).cast("bigint").alias("millions")


@_query
def velocity_money(spark, folder):
    windows = velocity.tumbling(_odd_money(spark, folder))
    return windows.select(_wall_clock("window_start"), "user_id", "n", _millions("total"))


@_query
def trailing_money(spark, folder):
    rows = velocity.trailing(_odd_money(spark, folder), keep=("event_id",))
    return rows.select("event_id", "n", _millions("mean_amount"))


@_query
def velocity_session(spark, folder):
    found = velocity.sessions(_tx(spark, folder))
    return found.withColumn("session_start", _wall_clock("session_start"))


@_query
def velocity_trailing(spark, folder):
    return velocity.trailing(_tx(spark, folder), keep=("event_id", "user_id"))


@_query
def burst_flag(spark, folder):
    return velocity.bursts(velocity_trailing(spark, folder))


# Delivery and generators


def _copies(transactions: DataFrame, *more: str) -> DataFrame:
    """Each transaction one to three times, later copies with a later arrival.

    Every tenth has lost its id.
    """
    copy = F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")))
    named = F.when(F.col("event_id") % 10 != 0, F.col("transaction_id"))
    return transactions.select(
        named.alias("transaction_id"), "user_id", "amount", copy.alias("arrival"), *more
    )


@_query
def tx_dedup(spark, folder):
    return dedup.first_copies(_copies(_tx(spark, folder)), "transaction_id", ["arrival"])


def _ids(spark: SparkSession, folder: str) -> DataFrame:
    return _tx(spark, folder).select(F.col("event_id").alias("id"))


@_query
def gen_training(spark, folder):
    return datagen.training_rows(_ids(spark, folder))


@_query
def gen_transactions(spark, folder):
    return datagen.transactions(_ids(spark, folder))


# Streams: the same chains, run by Structured Streaming to the end of its input


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A file stream takes a folder or a pattern; this one matches the one table.
    reader = pin_zone(spark).readStream.schema(events.EVENTS)
    return events.as_transactions(reader.parquet(f"{folder}/events.parque[t]"))


def _run_scoring(
    messages: DataFrame, *wanted: str, once: bool = False, committed: bool = False
) -> str:
    """Run the scoring stream to the end of its input; return its output root."""
    spark = messages.sparkSession
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    formats = {
        "scored_topic": "parquet", "alerts_topic": "parquet", "cases": "json",
        "dead_letter": "json",
    }
    sinks = {name: files(f"{root}/{name}", formats[name]) for name in wanted}
    query = scoring_stream.start(
        messages,
        model.pinned(spark),
        scoring_stream.Outputs(
            table=f"{root}/table", **sinks, show=0,
            ids=StoredIds(f"{root}/ids") if once else None, committed=committed,
        ),
        checkpoint=f"{root}/checkpoint",
        name=f"scoring-{uuid.uuid4().hex}",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return root


def _stream_of_parts(rows: DataFrame, parts: list[Column]) -> DataFrame:
    """A stream with a batch for each part of the rows, which arrive one after the other.

    A part has as many files as the rows have partitions, so they grow in number and not in
    size. A batch takes equally many, so a part of few rows is filled up with empty files.
    """
    spark = rows.sparkSession
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}/parts"
    files = rows.rdd.getNumPartitions()
    empty = spark.createDataFrame([], rows.schema).coalesce(1)
    for number, part in enumerate(parts):
        own = f"{root}/{number}"
        rows.where(part).repartition(files).write.parquet(own)
        written = spark.read.schema(rows.schema).parquet(own).inputFiles()
        for _ in range(files - len(written)):
            empty.write.mode("append").parquet(own)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return stream.parquet(f"{root}/*")


@_query
def stream_scored(spark, folder):
    root = _run_scoring(alerts.transaction_messages(_event_stream(spark, folder)))
    stored = spark.read.schema(schema.SCORED).parquet(f"{root}/table/run=*/batch_id=*")
    return stored.withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def stream_stored_once(spark, folder):
    """Every transaction delivered in a file of its own day and all again in a last one."""
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    sent = alerts.transaction_messages(_tx(spark, folder)).select("key", "value")
    for part in (sent.where("hash(key) % 2 = 0"), sent.where("hash(key) % 2 <> 0"), sent):
        part.write.mode("append").parquet(f"{root}/messages")
    stream = spark.readStream.schema(schema.MESSAGE).option("maxFilesPerTrigger", 2)
    table = _run_scoring(stream.parquet(f"{root}/messages"), once=True)
    stored = spark.read.schema(schema.SCORED).parquet(f"{table}/table/run=*/batch_id=*")
    return stored.withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def stream_committed(spark, folder):
    """Scores stored in three batches, committed, then compacted."""
    sent = alerts.transaction_messages(_tx(spark, folder)).select("key", "value")
    parts = [F.pmod(F.hash("key"), F.lit(3)) == part for part in range(3)]
    scored = _run_scoring(_stream_of_parts(sent, parts), committed=True)
    table = CommittedTable(spark, f"{scored}/table", schema.SCORED)
    table.compact()
    return table.read().withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def profiles_merged(spark, folder):
    """Profiles from sums of three batches: out of order, one replayed, two compacted."""
    profiles = Profiles(spark, f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}")
    rows = _odd_money(spark, folder)
    for part in (1, 0, 1, 2):
        some = rows.where(F.pmod(F.hash("event_id"), F.lit(3)) == part)
        profiles.add(some, BatchRef("profiles", part))
    profiles.compact()
    return profiles.read().select(
        _wall_clock("window_start"), "user_id", "n", _millions("total")
    )


# Days of event time that arrive as one batch.
_ARRIVAL_DAYS = 5


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of one batch for each five days; every 40th event comes two days late."""
    rows = _tx(spark, folder).select("event_id", "user_id", "ts", "amount")
    comes = F.unix_seconds("ts") + F.when(F.col("event_id") % 40 == 0, 2 * 86_400).otherwise(0)
    first = F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    part = F.least(F.floor((comes - first) / (_ARRIVAL_DAYS * 86_400)), F.lit(5))
    return _stream_of_parts(rows, [part == number for number in range(6)])


def _run_windows(spark: SparkSession, folder: str) -> str:
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    query = late_stream.start(
        _arrivals(spark, folder), f"{root}/windows", f"{root}/checkpoint",
        name=f"windows-{uuid.uuid4().hex}", trigger={"availableNow": True},
    )
    query.awaitTermination()
    return f"{root}/windows"


@_query
def stream_late(spark, folder):
    """The rows that came after their window had closed."""
    late = late_stream.late_rows(spark, _run_windows(spark, folder))
    return late.select("event_id", "user_id")


@_query
def stream_alerts(spark, folder):
    messages = alerts.transaction_messages(_event_stream(spark, folder))
    root = _run_scoring(messages, "alerts_topic")
    sent = spark.read.schema(schema.MESSAGE).parquet(f"{root}/alerts_topic/run=*/batch_id=*")
    return _fields(sent, schema.ALERT)


@_query
def stream_scored_topic(spark, folder):
    messages = alerts.transaction_messages(_event_stream(spark, folder))
    root = _run_scoring(messages, "scored_topic")
    sent = spark.read.schema(schema.MESSAGE).parquet(f"{root}/scored_topic/run=*/batch_id=*")
    decoded = _fields(sent, schema.SCORED)
    return decoded.withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def stream_alert_text(spark, folder):
    """Alert messages, as a stream of files, to readable text."""
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    frauds = plans.frauds(_messages(spark, folder), model.pinned(spark))
    alerts.alert_messages(frauds).write.parquet(f"{root}/alerts")
    query = alert_stream.start(
        spark.readStream.schema(schema.MESSAGE).parquet(f"{root}/alerts"),
        feed=files(f"{root}/feed", "parquet"), rejected=files(f"{root}/rejected", "json"),
        checkpoint=f"{root}/checkpoint", name=f"alerts-{uuid.uuid4().hex}",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    feed = spark.read.parquet(f"{root}/feed/run=*/batch_id=*")
    return feed.select("transaction_id", "alert_text", "warning")


def _run_table(frame: DataFrame, mode: str) -> DataFrame:
    """Run a stream to the end of its input; what it wrote, or in complete mode holds last."""
    spark = frame.sparkSession
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"

    def write(batch: DataFrame, batch_id: int) -> None:
        part = "all" if mode == "complete" else f"batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{root}/table/{part}")

    query = (
        frame.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{root}/table/*")


@_query
def stream_tumbling(spark, folder):
    """In complete mode: closed and open windows alike."""
    windows = _run_table(velocity.tumbling(_event_stream(spark, folder)), "complete")
    return windows.withColumn("window_start", _wall_clock("window_start"))


@_query
def stream_sessions(spark, folder):
    """In complete mode: closed and open sessions alike."""
    found = _run_table(velocity.sessions(_event_stream(spark, folder)), "complete")
    return found.withColumn("session_start", _wall_clock("session_start"))


@_query
def stream_bursts(spark, folder):
    """Windows of three or more that closed an hour before the last transaction."""
    root = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    query = burst_stream.start(
        alerts.transaction_messages(_event_stream(spark, folder)),
        f"{root}/bursts", f"{root}/checkpoint", name=f"bursts-{uuid.uuid4().hex}",
        trigger={"availableNow": True}, at_least=3,
    )
    query.awaitTermination()
    found = spark.read.schema("window_start timestamp, user_id string, n bigint").parquet(
        f"{root}/bursts"
    )
    return found.withColumn("window_start", _wall_clock("window_start"))


@_query
def stream_trailing(spark, folder):
    """Beside each transaction its user's last six hours, as far as they are closed."""
    rows = _event_stream(spark, folder).withWatermark("ts", "1 hour")
    return _run_table(velocity.trailing(rows, keep=("event_id", "user_id")), "append")


@_query
def stream_profile(spark, folder):
    """Beside each transaction its window's profile; every tenth has no user."""
    rows = _event_stream(spark, folder).withWatermark("ts", "1 hour")
    user = F.when(F.col("event_id") % 10 != 0, F.col("user_id"))
    profiled = velocity.with_profile(rows.withColumn("user_id", user))
    found = _run_table(
        profiled.select("event_id", "user_id", "user_n", "user_total"), "append"
    )
    return found


@_query
def stream_dedup(spark, folder):
    copies = _copies(_event_stream(spark, folder), "ts").withWatermark("ts", "60 days")
    kept = _run_table(dedup.stream_copies(copies, "transaction_id"), "append")
    return kept.select("transaction_id", "user_id", "amount")


@_query
def stream_cases(spark, folder):
    messages = alerts.transaction_messages(_event_stream(spark, folder))
    root = _run_scoring(messages, "cases")
    cases = spark.read.schema(schema.SCORED).json(f"{root}/cases/run=*/batch_id=*")
    return cases.withColumn("tx_timestamp", _wall_clock("tx_timestamp"))


@_query
def stream_dead_letters(spark, folder):
    root = _run_scoring(_damaged(_event_stream(spark, folder)), "dead_letter")
    return spark.read.schema(schema.DEAD_LETTER).json(f"{root}/dead_letter/run=*/batch_id=*")

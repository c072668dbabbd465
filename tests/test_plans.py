"""The physical plans the operators are meant to have."""

import re

import pytest

from riskstream import schema
from riskstream.operators import alerts, model
from riskstream.plans import queries
from tests.conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def query(spark, name):
    return plan(queries.registry()[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["scored_full", "fraud_alerts", "gen_transactions", "quarantine"])
def test_row_wise_chains_do_not_shuffle(spark, name):
    assert "Exchange" not in query(spark, name)


def test_no_python_runs_on_rows(spark):
    for name in queries.registry():
        if name.startswith("stream_") or name in ("auc", "fit_and_judge", "retrain"):
            continue
        assert "Python" not in query(spark, name), name


def test_scan_reads_only_what_is_used(spark):
    assert "props" not in query(spark, "scored_full")
    found = queries.registry()["velocity_trailing"](spark, FOLDER)
    found.collect()
    ran = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    read = re.findall(r"ReadSchema: struct<([^>]*)>", ran)
    # The rows, those without a time, and the changes, which three sums share.
    assert len(read) == 3
    used = {f.split(":")[0] for fields in read for f in fields.split(",")}
    assert used == {"event_id", "ts", "user_id", "value"}


def test_payload_is_parsed_once(spark):
    assert query(spark, "scored_full").count("from_json(") == 1


def test_forest_runs_once_and_after_the_rules(spark):
    text = query(spark, "fraud_alerts")
    scores = [line for line in text.splitlines() if "UDF(UDF(features" in line]
    assert len(scores) == 1
    lines = text.splitlines()
    at = lines.index(scores[0])
    # Deeper lines run earlier: the bound on the blended score is below the forest.
    assert any("Filter" in line and "> 0.7)" in line for line in lines[at:])


def test_alerts_are_read_back_with_a_pushed_filter(spark, tmp_path):
    path = f"{tmp_path}/scored"
    queries.registry()["scored_full"](spark, FOLDER).write.parquet(path)
    text = plan(alerts.alert_messages(spark.read.schema(schema.SCORED).parquet(path)))
    assert "EqualTo(prediction,FRAUD)" in text
    assert "payment_method" not in text


def test_preview_does_not_sort_the_table(spark):
    text = query(spark, "top_risk")
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


@pytest.mark.parametrize("name", ["velocity_tumbling", "velocity_sliding", "velocity_session"])
def test_windows_reduce_before_the_first_shuffle(spark, name):
    lines = query(spark, name).splitlines()
    deepest = max(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("HashAggregate" in line and "partial_" in line for line in lines[deepest:])


def test_copies_reduce_before_the_shuffle(spark):
    lines = query(spark, "tx_dedup").splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("partial_min" in line for line in lines[shuffle:])


def test_model_is_loaded_once(spark):
    assert model.pinned(spark) is model.pinned(spark)

import pytest
from pyspark.sql import functions as F

from riskstream import schema
from riskstream.operators import model, scoring
from riskstream.plans import forest_sql, training
from riskstream.sources import events
from riskstream.sources.tables import scored_table
from tests.conftest import TESTDATA


@pytest.fixture(scope="module")
def featured(spark):
    return scoring.with_features(events.transactions(spark, f"{TESTDATA}/sf0.001"))


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("train")
    fitted, auc = training.run(spark, f"{root}/none", f"{root}/model")
    return fitted, auc, f"{root}/model"


def test_fit_on_generated_rows(trained):
    fitted, auc, _ = trained
    assert auc > 0.95
    forest = fitted.stages[-1]
    assert (forest.getNumTrees, forest.getMaxDepth(), forest.getMaxBins()) == (20, 5, 32)
    assert forest.getImpurity() == "gini" and forest.getSeed() == model.SEED


def test_pinned_model_can_be_made_again(spark, trained, featured):
    keep = ["event_id", "fraud_probability"]
    shipped = scoring.with_probability(featured, model.pinned(spark)).select(keep)
    rebuilt = scoring.with_probability(featured, trained[0]).select(keep)
    assert shipped.exceptAll(rebuilt).isEmpty()


def test_save_then_load_scores_alike(spark, trained, featured):
    fitted, _, path = trained
    again = model.load(path)
    before = scoring.with_probability(featured, fitted).select("event_id", "fraud_probability")
    after = scoring.with_probability(featured, again).select("event_id", "fraud_probability")
    assert before.exceptAll(after).isEmpty()


def test_missing_model_fails_loudly(spark, tmp_path):
    with pytest.raises(Exception):
        model.load(f"{tmp_path}/none")


def test_unseen_and_null_categories_share_the_last_bucket(spark):
    rows = spark.createDataFrame(
        [("Tunis", "A"), ("Tunis", "B"), ("Sfax", "B"), (None, None), ("new", "new")],
        "location string, merchant_category string",
    )
    fitted = model.indexer().fit(rows.limit(3))
    assert [list(found) for found in fitted.labelsArray] == [["Tunis", "Sfax"], ["B", "A"]]
    got = [r.location_idx for r in fitted.transform(rows).collect()]
    assert got == [0.0, 0.0, 1.0, 2.0, 2.0]


def test_area_equals_rank_sum(spark):
    pairs = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (0.4, 0), (0.9, 0)]
    frame = spark.createDataFrame(pairs, "p double, label int")
    positives = [p for p, y in pairs if y]
    negatives = [p for p, y in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in positives for b in negatives)
    expected = wins / (len(positives) * len(negatives))
    assert model.area_under_roc(frame, "p") == pytest.approx(expected, abs=1e-12)


def test_split_is_stable_and_complete(spark, featured):
    split = model.with_split(featured, "event_id")
    parts = {r.is_train: r["count"] for r in split.groupBy("is_train").count().collect()}
    assert sum(parts.values()) == 1000 and 750 < parts[True] < 850
    again = model.with_split(featured.repartition(5), "event_id")
    keep = ["event_id", "is_train"]
    assert split.select(keep).exceptAll(again.select(keep)).isEmpty()
    by_text = model.with_split(featured, "transaction_id")
    assert 740 < by_text.where("is_train").count() < 860


def test_retrain_from_own_output(spark, featured, trained, tmp_path):
    scored = scoring.decide(scoring.with_probability(featured, trained[0]))
    path = f"{tmp_path}/scored"
    scored.select(schema.SCORED_FIELDS).write.parquet(f"{path}/run=a/batch_id=0")
    fitted, auc = training.run(spark, path, f"{tmp_path}/model")
    assert len(fitted.stages) == 3 and 0.5 < auc <= 1.0


def test_scored_table_guard(spark, tmp_path):
    assert scored_table(spark, f"{tmp_path}/none") is None
    empty = f"{tmp_path}/empty"
    spark.createDataFrame([], schema.SCORED).write.parquet(empty)
    assert scored_table(spark, empty) is None


def test_relabel_uses_raw_inputs_only(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 3, 1, "Tunis", "X", 6), ("b", 1.0, 3, 1, "Tunis", "X", 7)],
        "transaction_id string, amount double, tx_hour int, is_online int, location string,"
        " merchant_category string, risk_level int",
    )
    got = model.relabelled(rows)
    assert got.columns == ["transaction_id", *schema.MODEL_INPUTS, "label"]
    assert [r.label for r in got.collect()] == [0, 1]


def test_rendered_forest_is_current():
    with open(forest_sql.RENDERED) as text:
        assert text.read() == forest_sql.render()


def test_published_once_into_the_shared_folder(spark):
    first = model.publish(spark, model.PINNED)
    assert model.publish(spark, model.PINNED) == first
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/models/")
    assert len(model.load(first).stages) == 3


def test_scores_do_not_depend_on_partitioning(spark, featured):
    one = scoring.with_probability(featured.coalesce(1), model.pinned(spark))
    many = scoring.with_probability(featured.repartition(6), model.pinned(spark))
    keep = ["event_id", "fraud_probability"]
    assert one.select(keep).exceptAll(many.select(keep)).isEmpty()
    assert one.where((F.col("fraud_probability") < 0) | (F.col("fraud_probability") > 1)).isEmpty()


def test_more_labels_than_bins(spark, featured):
    many = featured.withColumn(
        "location", F.concat(F.lit("city "), (F.col("event_id") % 40).cast("string"))
    ).withColumn("label", (F.col("amount") > 5000).cast("int"))
    fitted, area = model.fit(many, "event_id")
    assert len(fitted.stages[0].labelsArray[0]) == 40 and area > 0.9


def test_category_index_is_the_indexers(spark, featured):
    fitted = model.indexer().fit(featured.select(schema.CATEGORY_INPUTS))
    expected = {
        (field, label, float(i))
        for field, found in zip(schema.CATEGORY_INPUTS, fitted.labelsArray)
        for i, label in enumerate(found)
    }
    found = model.category_index(featured)
    assert set(map(tuple, found.collect())) == expected
    assert "FileScan" in found._jdf.queryExecution().executedPlan().toString()

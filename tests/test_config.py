import pytest

from riskstream import session
from riskstream.config import GeneratorConfig, Policy, StreamConfig


def test_defaults():
    config = StreamConfig.from_env({})
    assert config == StreamConfig()
    assert (config.transaction_topic, config.scored_topic, config.alerts_topic) == (
        "transactions", "scored-transactions", "fraud-alerts",
    )
    assert Policy.from_env({}) == Policy(0.6, 0.7, 0.4)
    assert GeneratorConfig.from_env({}) == GeneratorConfig(
        1.0, 0.1, ("Tunis", "Sousse", "Sfax", "Monastir")
    )


def test_settings_override():
    config = StreamConfig.from_env({"ALERTS_TOPIC": "a", "MODEL_PATH": "/m"})
    assert (config.alerts_topic, config.model_path) == ("a", "/m")
    policy = Policy.from_env({"ML_WEIGHT": "0.25", "FRAUD_THRESHOLD": "0.9"})
    assert (policy.ml_weight, policy.rule_weight, policy.fraud_threshold) == (0.25, 0.75, 0.9)
    made = GeneratorConfig.from_env(
        {"PRODUCER_INTERVAL": "0.5", "PRODUCER_VELOCITY_PROBABILITY": "0", "LOCATIONS": "A,B"}
    )
    assert made == GeneratorConfig(0.5, 0.0, ("A", "B"))


def test_shared_folder(spark, monkeypatch):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Elsewhere:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        session.shared_folder(Elsewhere)
    Elsewhere.sparkContext.master = "local[4]"
    assert session.shared_folder(Elsewhere) == session.shared_folder(Elsewhere)


def test_paths_must_be_shared(spark):
    assert session.shared_path(spark, "data/x").startswith("file:/")

    class Elsewhere:
        class sparkContext:
            master = "yarn"
            _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    with pytest.raises(RuntimeError):
        session.shared_path(Elsewhere, "./data/x")


def test_queries_leave_the_session_as_it_was(spark):
    from riskstream.plans import queries

    def settings():
        return {r["key"]: r["value"] for r in spark.sql("SET").collect()}

    spark.conf.set("spark.sql.session.timeZone", session.ZONE)
    before = settings()
    queries.registry()["velocity_tumbling"](spark, "/root/testdata/sf0.001").collect()
    assert settings() == before

"""Settings of the decision step and of the streaming job."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Policy:
    """How a model probability and the rules become one decision."""

    ml_weight: float = 0.6
    fraud_threshold: float = 0.7
    suspicious_threshold: float = 0.4

    def __post_init__(self) -> None:
        if not 0.0 <= self.ml_weight <= 1.0:
            raise ValueError(f"ml_weight must be within 0..1, got {self.ml_weight}")
        if not self.suspicious_threshold <= self.fraud_threshold:
            raise ValueError("suspicious_threshold must not exceed fraud_threshold")

    @property
    def rule_weight(self) -> float:
        # One double subtraction; a decimal 1 - w would round differently.
        return 1.0 - self.ml_weight

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Policy:
        return cls(
            ml_weight=float(env.get("ML_WEIGHT", cls.ml_weight)),
            fraud_threshold=float(env.get("FRAUD_THRESHOLD", cls.fraud_threshold)),
        )


def _setting(variable: str, default: str):
    return field(default=default, metadata={"env": variable})


@dataclass(frozen=True)
class StreamConfig:
    """Where the streaming job reads and writes."""

    bootstrap_servers: str = _setting("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    transaction_topic: str = _setting("TRANSACTION_TOPIC", "transactions")
    scored_topic: str = _setting("SCORED_TOPIC", "scored-transactions")
    alerts_topic: str = _setting("ALERTS_TOPIC", "fraud-alerts")
    checkpoint_dir: str = _setting("CHECKPOINT_DIR", "./data/checkpoints")
    processed_path: str = _setting("PROCESSED_DATA_PATH", "./data/processed")
    fraud_path: str = _setting("FRAUD_CASES_PATH", "./data/fraud_cases")
    dead_letter_path: str = _setting("DEAD_LETTER_PATH", "./data/dead_letter")
    model_path: str = _setting("MODEL_PATH", "./models/fraud_model")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> StreamConfig:
        return cls(**{f.name: env.get(f.metadata["env"], f.default) for f in fields(cls)})


@dataclass(frozen=True)
class GeneratorConfig:
    """Pace and shape of generated traffic."""

    interval: float = 1.0
    burst_probability: float = 0.1
    locations: tuple[str, ...] = ("Tunis", "Sousse", "Sfax", "Monastir")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> GeneratorConfig:
        return cls(
            interval=float(env.get("PRODUCER_INTERVAL", cls.interval)),
            burst_probability=float(
                env.get("PRODUCER_VELOCITY_PROBABILITY", cls.burst_probability)
            ),
            locations=tuple(env.get("LOCATIONS", ",".join(cls.locations)).split(",")),
        )

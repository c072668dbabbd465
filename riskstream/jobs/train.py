"""Fit the forest and save it.

    spark-submit --py-files riskstream.zip riskstream/jobs/train.py
"""

from __future__ import annotations

from riskstream import session
from riskstream.config import StreamConfig
from riskstream.plans import training


def main() -> None:
    config = StreamConfig.from_env()
    spark = session.builder("riskstream-train").getOrCreate()
    stored, saved = (
        session.shared_path(spark, path) for path in (config.processed_path, config.model_path)
    )
    _, auc = training.run(spark, stored, saved)
    print(f"saved {saved}; holdout area under ROC {auc:.4f}")


if __name__ == "__main__":
    main()

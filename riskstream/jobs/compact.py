"""Rewrite what the scoring stream stored in small batches; needs its ``--committed``.

    spark-submit --py-files riskstream.zip riskstream/jobs/compact.py

Readers and the stream go on meanwhile. Files out of use for a day are deleted.
"""

from __future__ import annotations

import argparse

from riskstream import schema, session
from riskstream.config import StreamConfig
from riskstream.streaming.committed import CommittedTable, is_committed
from riskstream.streaming.profiles import Profiles


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("--files", type=int, help="files that a compaction writes; by size unless given")
    args.add_argument("--profiles", help="folder of users' profiles to compact as well")
    args.add_argument("--keep", type=float, default=86_400, help="seconds to keep unused files")
    given = args.parse_args(argv)

    spark = session.builder("riskstream-compact").getOrCreate()
    root = session.shared_path(spark, StreamConfig.from_env().processed_path)
    if not is_committed(spark, root):
        raise SystemExit(f"{root} has no commits; score with --committed")
    scores = CommittedTable(spark, root, schema.SCORED)
    print(f"{scores.compact(given.files)} batches rewritten, {scores.vacuum(given.keep)} folders gone")
    if given.profiles:
        profiles = Profiles(spark, session.shared_path(spark, given.profiles))
        profiles.compact(given.files)
        profiles.table.vacuum(given.keep)


if __name__ == "__main__":
    main()

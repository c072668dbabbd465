"""Several streams as one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.streaming import StreamingQuery

TURN = 1  # seconds for which one query is waited for before the next one is asked


def until_all_end(queries: Sequence[StreamingQuery]) -> None:
    """Wait until all have ended; when one fails, stop the others and raise its error.

    Queries are asked in turn, not waited for one after another: a failed one is seen
    however long the others run. Other queries of the session are left alone.
    """
    waiting = list(queries)
    try:
        while waiting:
            for query in list(waiting):
                if query.awaitTermination(TURN):
                    waiting.remove(query)
    finally:
        for query in waiting:
            query.stop()

"""Per-user activity over event-time windows.

Transactions come with ``user_id``, ``ts`` (TIMESTAMP) and ``amount``. No step
brings all rows of a busy user together: rows are first reduced, map side, to
one row per user and *pane* (a short stretch of time), so what reaches a user's
group is bounded by the time span over the pane and not by the user's traffic.
Rows without a time are in no window. A sum or mean over an amount that is not
finite, or beyond 10^21, is null.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.functions.features import from_micros, half_up, micros, unsummable

HOUR = 3600
SECOND = 1_000_000  # in microseconds


def _clock(seconds: float) -> str:
    return f"{round(seconds * SECOND)} microseconds"


def _instant(value: Column) -> Column:
    """Microseconds since the epoch back to a TIMESTAMP."""
    return F.timestamp_micros(value)


def _pane(time: Column, length: int) -> Column:
    """First microsecond of the pane of ``length`` microseconds that holds ``time``."""
    return time - F.pmod(time, F.lit(length))


def _total(amount: Column) -> Column:
    """The sum; null if an amount is not finite or too large to be summed exactly."""
    total = half_up(from_micros(F.sum(micros(amount))), 2)
    return F.when(F.count(F.when(unsummable(amount), 1)) == 0, total)


def tumbling(transactions: DataFrame, seconds: float = 6 * HOUR) -> DataFrame:
    """Count and sum per user and window; batch or stream."""
    return (
        transactions.groupBy(F.window("ts", _clock(seconds)), "user_id")
        .agg(F.count(F.lit(1)).alias("n"), _total(F.col("amount")).alias("total"))
        .select(F.col("window.start").alias("window_start"), "user_id", "n", "total")
    )


def with_profile(transactions: DataFrame, seconds: float = 6 * HOUR) -> DataFrame:
    """Each transaction beside its user's count and sum in the window it falls in.

    A left join to the tumbling profile on user and window: the profile is
    reduced map side, and a user's rows spread over their windows. The profile
    is shuffled once more to its window's start, which lets adaptive execution
    split the rows of a window too busy for one task; a window function, or a
    join straight onto the grouping, would rule that out. No user, no profile.

    A stream gives a transaction when its window has closed, and one without a user when
    no profile can come for it any more: both sides are held no longer than a window
    and the watermark's delay.
    """
    if transactions.isStreaming:
        return _stream_profile(transactions, seconds)
    profile = tumbling(transactions, seconds).withColumnsRenamed(
        {"n": "user_n", "total": "user_total"}
    )
    start = _instant(_pane(F.unix_micros("ts"), round(seconds * SECOND)))
    placed = transactions.withColumn("window_start", start)
    return placed.join(profile, ["user_id", "window_start"], "left").select(
        *transactions.columns, "user_n", "user_total"
    )


def _stream_profile(transactions: DataFrame, seconds: float) -> DataFrame:
    length = round(seconds * SECOND)
    windows = (
        transactions.groupBy(
            F.window("ts", f"{length} microseconds").alias("w"), F.col("user_id").alias("user_id_")
        )
        .agg(F.count(F.lit(1)).alias("user_n"), _total(F.col("amount")).alias("user_total"))
        .select(
            "user_id_", "user_n", "user_total", F.col("w.start").alias("start"),
            F.window_time("w").alias("closes"),
        )
    )
    start = _instant(_pane(F.unix_micros("ts"), length))
    placed = transactions.where(F.col("ts").isNotNull()).withColumn("window_start", start)
    same = (F.col("user_id") == F.col("user_id_")) & (F.col("window_start") == F.col("start"))
    span = F.expr(f"INTERVAL '{length / SECOND:.6f}' SECOND")
    near = (F.col("closes") >= F.col("ts")) & (F.col("closes") <= F.col("ts") + span)
    joined = placed.join(windows, same & near, "left").select(
        *transactions.columns, "user_n", "user_total"
    )
    none = transactions.where(F.col("ts").isNull()).withColumns(
        {"user_n": F.lit(None).cast("bigint"), "user_total": F.lit(None).cast("double")}
    )
    return joined.union(none)


def sliding(
    transactions: DataFrame, seconds: float = 6 * HOUR, slide: float = 2 * HOUR
) -> DataFrame:
    """Count per user and overlapping window; batch or stream.

    A window is a run of panes as long as what divides both the window and the slide.
    A batch counts its rows once per pane and copies only the counts to the windows.
    """
    length, step = round(seconds * SECOND), round(slide * SECOND)
    if transactions.isStreaming:
        return (
            transactions.groupBy(F.window("ts", _clock(seconds), _clock(slide)), "user_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"), "user_id", "n")
        )
    timed = transactions.where(F.col("ts").isNotNull())
    pane = _pane(F.unix_micros("ts"), gcd(length, step))
    panes = timed.groupBy("user_id", pane.alias("pane")).agg(F.count(F.lit(1)).alias("n"))
    # The last window that begins by the pane, and those before it that still hold it.
    last = _pane(F.col("pane"), step)
    first = last - F.floor((F.lit(length - 1) - (F.col("pane") - last)) / step) * step
    starts = F.when(first <= last, F.sequence(first, last, F.lit(step)))
    return (
        panes.select("user_id", F.explode(starts).alias("start"), "n")
        .groupBy("user_id", "start")
        .agg(F.sum("n").alias("n"))
        .select(_instant(F.col("start")).alias("window_start"), "user_id", "n")
    )


def sessions(transactions: DataFrame, gap: float = 6 * HOUR) -> DataFrame:
    """Count per user and session; a pause longer than ``gap`` ends a session.

    In batch, rows that share a pane of one gap's length always share a
    session, so a pane is reduced to its first and last instant and its count
    before panes are chained.
    """
    if transactions.isStreaming:
        return (
            transactions.groupBy(F.session_window("ts", _clock(gap)), "user_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("session_window.start").alias("session_start"), "user_id", "n")
        )
    length = round(gap * SECOND)
    at = F.unix_micros("ts")
    timed = transactions.where(F.col("ts").isNotNull())
    panes = timed.groupBy("user_id", _pane(at, length).alias("pane")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")
    )
    in_order = Window.partitionBy("user_id").orderBy("pane")
    starts = F.coalesce(F.col("first") - F.lag("last").over(in_order) > length, F.lit(True))
    return (
        panes.withColumn("starts", starts.cast("int"))
        .withColumn("session", F.sum("starts").over(in_order))
        .groupBy("user_id", "session")
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        .select(_instant(F.col("first")).alias("session_start"), "user_id", "n")
    )


def _user() -> Column:
    """The user as a key that is never null: rows without a user count as one user."""
    return F.coalesce(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("none"))


# What a trailing window holds, beside the columns of a transaction.
HELD = ("held_n", "held_worth", "held_odd")


def _running(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Sums of a user's changes up to and at each of their instants ``at``.

    They are taken over the instants of an hour and over the hours of a user, groups that
    time bounds whatever a user sends. An hour's instants are put in place once: the sum
    within the hour and the join with the hours before share it.
    """

    def summed(within: list[str], order: str, last: int) -> dict[str, Column]:
        past = Window.partitionBy(*within).orderBy(order).rowsBetween(
            Window.unboundedPreceding, last
        )
        return {c: F.sum(c).over(past) for c in columns}

    hours = changes.groupBy("user", "hour").agg(*[F.sum(c).alias(c) for c in columns])
    hours = hours.withColumns(summed(["user"], "hour", -1))
    hours = hours.select("user", "hour", *[F.col(c).alias(f"{c}_before") for c in columns])
    instants = changes.withColumns(summed(["user", "hour"], "at", Window.currentRow))
    sums = [
        (F.col(c) + F.coalesce(F.col(f"{c}_before"), F.lit(0))).cast(changes.schema[c].dataType)
        for c in columns
    ]
    # Every hour is there; an outer join adds no filter that would tell the two sides apart.
    return instants.join(hours, ["user", "hour"], "left").select(
        "user", "at", *[total.alias(c) for total, c in zip(sums, columns, strict=True)]
    )


def trailing(
    transactions: DataFrame,
    seconds: float = 6 * HOUR,
    keep: tuple[str, ...] = ("transaction_id", "user_id", "ts"),
) -> DataFrame:
    """Per transaction, count and mean amount of its user over ``[ts - d, ts]``.

    A row is a change at its instant, and one the other way at the first instant past its
    window; a user's changes are added up by instant, map side, and their running sum is
    what the window holds. Work is linear in the rows, for every user alike, and no group
    grows with what a user sends: instants are bounded by time, and the rows of one too
    busy instant are split by adaptive execution. A row without a time is in no window and
    isn't shuffled.

    A stream, which has no order to run a sum in, adds up panes instead; see
    ``_stream_trailing``.
    """
    if transactions.isStreaming:
        return _stream_trailing(transactions, seconds, keep)
    past = round(seconds * SECOND) + 1  # a row still counts at the very end of its window
    rows = transactions.withColumn("at", F.unix_micros("ts"))
    timeless = rows.where("at is null").select(
        *keep, F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("mean_amount")
    )
    timed = rows.where("at is not null").select(*keep, "at", _user().alias("user"), "amount")
    worth = F.coalesce(micros(F.col("amount")), F.lit(0).cast("decimal(38,0)"))
    odd = unsummable(F.col("amount")).cast("int")
    columns = ["n", "worth", "odd"]
    ways = [(F.col("at"), F.lit(1), worth, odd), (F.col("at") + past, F.lit(-1), -worth, -odd)]
    changes = (
        timed.select(
            "user",
            F.inline(
                F.array(*[
                    F.struct(*[c.alias(name) for c, name in zip(way, ["at", *columns], strict=True)])
                    for way in ways
                ])
            ),
        )
        .groupBy("user", F.floor(F.col("at") / (HOUR * SECOND)).alias("hour"), "at")
        .agg(*[F.sum(c).alias(c) for c in columns])
    )
    held = _running(changes, columns).toDF("user_", "at_", *HELD)
    same = (F.col("user") == F.col("user_")) & (F.col("at") == F.col("at_"))
    n, worth, odd = (F.col(c) for c in HELD)
    mean = half_up(from_micros(worth) / F.nullif(n, F.lit(0)).cast("double"), 2)
    found = timed.join(held, same).select(
        *keep, n.alias("n"), F.when(odd == 0, mean).alias("mean_amount")
    )
    return found.union(timeless)


# Panes of a trailing window in a stream.
PANES = 12


def _held() -> list[Column]:
    amount = F.col("amount")
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(micros(amount)), F.lit(0).cast("decimal(38,0)")).alias("worth"),
        F.count(F.when(unsummable(amount), 1)).alias("odd"),
    ]


def _stream_trailing(
    transactions: DataFrame, seconds: float, keep: tuple[str, ...]
) -> DataFrame:
    """Trailing counts and means in a stream, in append mode.

    A transaction's window is cut at panes. The whole panes between its ends meet the
    users' sums by pane, by a row for each of the one or two blocks of panes they lie in;
    the pane at either end, a row with a key of its own, meets the sums by instant, of
    those instants that the window holds. So a busy user's rows are spread over panes and
    blocks, and what one meets is bounded by panes and by the instants of two panes. All
    the parts are added up again when no late row can
    change them: the joins and sums hold rows for the window and the watermark's delay.
    The watermark must be set; ``keep`` must tell transactions apart.
    """
    window = round(seconds * SECOND)
    length = -(-window // PANES)
    span = F.expr(f"INTERVAL '{window / SECOND:.6f}' SECOND")
    at = F.unix_micros("ts")
    timed = transactions.where(F.col("ts").isNotNull()).withColumn("user", _user())
    kept = list(dict.fromkeys([*keep, "ts"]))
    first, last = F.floor((at - window) / length), F.floor(at / length)
    ends = timed.select(
        *kept, "user", F.explode(F.array_distinct(F.array(first, last))).alias("key")
    )
    blocks = [F.floor(pane / PANES) for pane in (first + 1, last - 1)]
    between = timed.where(last - first > 1).select(
        *kept, "user", first.alias("first"), last.alias("last"),
        F.explode(F.sequence(*blocks)).alias("key"),
    )
    sent = timed.select(F.col("user").alias("of"), F.col("ts").alias("then"), "amount")
    instants = sent.groupBy("of", "then").agg(*_held())
    panes = sent.groupBy("of", F.window("then", f"{length} microseconds").alias("w")).agg(*_held())
    panes = panes.select("of", F.window_time("w").alias("then"), "n", "worth", "odd")
    pane = F.floor(F.unix_micros("then") / length)

    def met(cuts: DataFrame, sums: DataFrame, also: Column = F.lit(True)) -> DataFrame:
        same = (F.col("user") == F.col("of")) & (F.col("key") == F.col("in"))
        within = (F.col("then") <= F.col("ts")) & (F.col("then") >= F.col("ts") - span)
        return cuts.join(sums, same & within & also).select(*kept, "n", "worth", "odd")

    whole = (F.col("pane") > F.col("first")) & (F.col("pane") < F.col("last"))
    parts = met(ends, instants.withColumn("in", pane)).union(
        met(between, panes.withColumns({"pane": pane, "in": F.floor(pane / PANES)}), whole)
    )
    held = parts.groupBy(*kept).agg(*[F.sum(c).alias(c) for c in ("n", "worth", "odd")])
    mean = half_up(from_micros(F.col("worth")) / F.col("n").cast("double"), 2)
    found = held.select(*keep, "n", F.when(F.col("odd") == 0, mean).alias("mean_amount"))
    timeless = transactions.where(F.col("ts").isNull()).select(
        *keep, F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("mean_amount")
    )
    return found.union(timeless)


def bursts(trailed: DataFrame, at_least: int = 5) -> DataFrame:
    """Transactions, or windows, whose count reaches ``at_least``."""
    return trailed.where(F.col("n") >= at_least)

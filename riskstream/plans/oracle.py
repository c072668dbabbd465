"""Each driver query as SQL over the same tables, for a second engine.

Doubles are written with an exponent (``0.6e0``) so that no decimal arithmetic
creeps in, and casts to integer follow an explicit ``trunc`` or ``floor``.
"""

from __future__ import annotations

from riskstream.plans import forest_sql

_TX = """tx AS (
  SELECT event_id,
    CAST(event_id AS VARCHAR) AS transaction_id,
    'USER_' || CAST(user_id + 1000 AS VARCHAR) AS user_id,
    ts,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    value * 40e0 AS amount,
    'TND' AS currency,
    CASE event_id % 8 WHEN 7 THEN 'FOREIGN_REMOTE' WHEN 3 THEN 'Monastir'
      WHEN 0 THEN 'Tunis' WHEN 4 THEN 'Tunis' WHEN 1 THEN 'Sousse' WHEN 5 THEN 'Sousse'
      ELSE 'Sfax' END AS location,
    CASE event_id % 4 WHEN 0 THEN 'CARD' WHEN 1 THEN 'MOBILE_PAYMENT'
      WHEN 2 THEN 'BANK_TRANSFER' ELSE 'CASH' END AS payment_method,
    CASE event_type WHEN 'click' THEN 'GROCERY' WHEN 'view' THEN 'FASHION'
      WHEN 'signup' THEN 'ELECTRONICS' WHEN 'purchase' THEN 'RESTAURANT'
      WHEN 'error' THEN 'TRAVEL' END AS merchant_category,
    CAST(event_id % 2 = 0 AS INTEGER) AS is_online,
    'DEV_' || CAST(user_id % 900 + 100 AS VARCHAR) AS device_id,
    ts AS tx_timestamp,
    CAST(hour(ts) AS INTEGER) AS tx_hour,
    CAST(event_id * 7919 % 1001 AS DOUBLE) / 1000e0 AS stand_in
  FROM events)"""

_TRANSACTION = (
    'transaction_id, user_id, "timestamp", amount, currency, location, payment_method,'
    " merchant_category, is_online = 1 AS is_online, device_id"
)

_RULES = """((CASE WHEN amount > 5000e0 THEN 0.5e0 ELSE 0e0 END
      + CASE WHEN tx_hour < 5 THEN 0.3e0 ELSE 0e0 END)
      + CASE WHEN location = 'FOREIGN_REMOTE' THEN 0.2e0 ELSE 0e0 END)"""


def _decided(source: str, weight: float = 0.6, fraud: float = 0.7) -> str:
    """``source`` holds transactions with a ``fraud_probability``."""
    return f"""ruled AS (SELECT *, {_RULES} AS rule_score FROM {source}),
blended AS (
  SELECT *, fraud_probability * {weight!r}e0 + rule_score * {1 - weight!r}e0 AS final_fraud_score FROM ruled),
scored AS (
  SELECT *,
    CAST(trunc(final_fraud_score * 10e0) AS INTEGER) AS risk_level,
    CASE WHEN final_fraud_score > {fraud!r}e0 THEN 'FRAUD'
      WHEN final_fraud_score > 0.4e0 THEN 'SUSPICIOUS' ELSE 'NORMAL' END AS prediction,
    CASE WHEN final_fraud_score > {fraud!r}e0 THEN 'High ML Alert + Risky Rules'
      WHEN fraud_probability > 0.8e0 THEN 'Extreme ML Anomaly'
      WHEN rule_score > 0.8e0 THEN 'High Rule Trigger'
      ELSE 'Normal activity' END AS reason
  FROM blended)"""


_SCORED = (
    'transaction_id, user_id, "timestamp", amount, currency, location, payment_method,'
    " merchant_category, is_online, device_id, tx_timestamp, tx_hour, fraud_probability,"
    " rule_score, final_fraud_score, risk_level, prediction, reason"
)
# JSON keeps timestamps to the millisecond.
_SCORED_JSON = _SCORED.replace(
    "tx_timestamp", "date_trunc('milliseconds', tx_timestamp) AS tx_timestamp"
)
_ALERT = "transaction_id, user_id, risk_level, fraud_probability, reason"

_LABELLED = """labelled AS (
  SELECT *, CASE WHEN fraud_prob > 0.6e0 THEN 1 ELSE 0 END AS label
  FROM (SELECT *,
    (((CASE WHEN amount > 5000e0 THEN 0.4e0 ELSE 0e0 END
     + CASE WHEN tx_hour < 6 OR tx_hour > 22 THEN 0.2e0 ELSE 0e0 END)
     + CASE WHEN location = 'FOREIGN_REMOTE' THEN 0.4e0 ELSE 0e0 END)
     + stand_in * 0.2e0) AS fraud_prob
    FROM {source}))"""

_MICROS = "CAST(round_even(amount * 1e6, 0) AS HUGEINT)"


def _cents(value: str) -> str:
    return f"floor(({value}) * 100e0 + 0.5e0) / 100e0"


def _uniform(stream: str, ids: str, part: int, seed: int = 42) -> str:
    text = f"'{seed}:{stream}:' || {ids}"
    word = f"substr(md5({text}), {8 * part + 1}, 8)"
    return f"(CAST(CAST('0x' || {word} AS BIGINT) AS DOUBLE) / 4294967296e0)"


def _integer(u: str, low: int, high: int) -> str:
    return f"(CAST(floor({u} * {high - low + 1}e0) AS INTEGER) + {low})"


def _choice(u: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], {_integer(u, 1, len(values))})"


def _amount(u: str, low: float, high: float) -> str:
    return f"floor(({u} * {high - low!r}e0 + {low!r}e0) * 1000e0 + 0.5e0) / 1000e0"


def _generated_training() -> str:
    def u(stream: str, part: int) -> str:
        return _uniform(stream, "CAST(event_id AS VARCHAR)", part)

    return f"""WITH drawn AS (
  SELECT event_id AS id,
    {u('train-a', 0)} * 10000e0 AS amount,
    {_integer(u('train-a', 1), 0, 23)} AS tx_hour,
    CAST({u('train-a', 2)} > 0.5e0 AS INTEGER) AS is_online,
    {_choice(u('train-a', 3), ['Tunis', 'Sousse', 'Sfax', 'FOREIGN_REMOTE'])} AS location,
    {_choice(u('train-b', 0), ['GROCERY', 'ELECTRONICS', 'TRAVEL'])} AS merchant_category,
    {u('train-b', 1)} AS stand_in
  FROM events),
{_LABELLED.format(source='drawn')}
SELECT id, amount, tx_hour, is_online, location, merchant_category, fraud_prob, label
FROM labelled"""


def _generated_transactions() -> str:
    cities = ["Tunis", "Sousse", "Sfax", "Monastir"]

    def burst(part: int, stream: str = "burst") -> str:
        return _uniform(stream, "CAST(id AS VARCHAR)", part)

    def u(stream: str, part: int) -> str:
        return _uniform(
            f"tx-{stream}", "CAST(id AS VARCHAR) || ':' || CAST(step AS VARCHAR)", part
        )

    digest = "md5('42:tx-ident:' || CAST(id AS VARCHAR) || ':' || CAST(step AS VARCHAR))"
    categories = ["GROCERY", "ELECTRONICS", "RESTAURANT", "TRAVEL", "FASHION", "PHARMACY"]
    return f"""WITH plan AS (
  SELECT event_id AS id, {burst(0).replace('id AS', 'event_id AS')} < 0.1e0 AS is_burst FROM events),
steps AS (
  SELECT id, is_burst, CAST(unnest(generate_series(0,
    CASE WHEN is_burst THEN {_integer(burst(1), 5, 12)} ELSE 1 END - 1)) AS INTEGER) AS step
  FROM plan),
drawn AS (
  SELECT *, {u('a', 0)} < 0.05e0 AS suspicious, {digest} AS d FROM steps)
SELECT
  substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-4' || substr(d, 14, 3) || '-a'
    || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS transaction_id,
  CASE WHEN is_burst THEN 'VOL_' || {_integer(burst(2), 1000, 9999)}
    ELSE 'USER_' || {_integer(u('b', 0), 1000, 9999)} END AS user_id,
  strftime(make_timestamp(1767225600000000 + id * 1000000 + step * 100000),
    '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
  CASE WHEN suspicious THEN {_amount(u('a', 1), 2000.0, 10000.0)}
    ELSE {_amount(u('a', 1), 5.0, 500.0)} END AS amount,
  'TND' AS currency,
  CASE WHEN suspicious AND {u('a', 3)} < 0.5e0 THEN 'FOREIGN_REMOTE'
    WHEN is_burst THEN {_choice(burst(0, 'burst-city'), cities)}
    ELSE {_choice(u('a', 2), cities)} END AS location,
  {_choice(u('b', 2), ['CARD', 'MOBILE_PAYMENT', 'BANK_TRANSFER', 'CASH'])} AS payment_method,
  {_choice(u('b', 3), categories)} AS merchant_category,
  substr(d, 13, 1) < '8' AS is_online,
  CASE WHEN is_burst THEN 'DEV_BOT_' || {_integer(burst(3), 10, 99)}
    ELSE 'DEV_' || {_integer(u('b', 1), 100, 999)} END AS device_id
FROM drawn"""


def _quarantine() -> str:
    tail = ',"is_online":true,"timestamp":"2024-01-01T00:00:00"'
    # Payload (around the id) and cause for each kind of damage.
    kinds = {
        1: ("'not json ' || transaction_id", "malformed json"),
        2: ("''", "empty payload"),
        3: ("NULL", "empty payload"),
        4: (_payload(tail), "missing amount"),
        5: (_payload(',"amount":"12.5"' + tail), "malformed json"),
        6: (_payload(',"amount":1e400' + tail), "amount not finite"),
        7: (_payload(',"amount":NaN' + tail), "amount not finite"),
        8: (_payload(',"amount":12.5,"timestamp":"2024-01-01T00:00:00"'), "missing is_online"),
        9: (
            _payload(',"amount":12.5,"is_online":1,"timestamp":"2024-01-01T00:00:00"'),
            "malformed json",
        ),
        10: (_payload(',"amount":12.5,"is_online":true'), "unreadable timestamp"),
        11: (_payload(',"amount":12.5,"is_online":true,"timestamp":"bogus"'), "unreadable timestamp"),
        12: (
            "'[' || " + _payload(',"amount":12.5' + tail) + " || ']'",
            "malformed json",
        ),
        13: ("'{\"AMOUNT\":1.0" + tail + "}'", "missing amount"),
    }
    values = " ".join(f"WHEN {k} THEN {payload}" for k, (payload, _) in kinds.items())
    causes = " ".join(f"WHEN {k} THEN '{cause}'" for k, (_, cause) in kinds.items())
    return (
        f"WITH {_TX} SELECT CASE event_id % 14 {values} END AS value,"
        f" CASE event_id % 14 {causes} END AS cause FROM tx WHERE event_id % 14 <> 0"
    )


def _payload(after_id: str) -> str:
    return f"'{{\"transaction_id\":\"' || transaction_id || '\"{after_id}}}'"


def queries() -> dict[str, str]:
    with open(forest_sql.RENDERED) as text:
        forest = f"forest AS ({text.read()})"
    stand_in = "stand AS (SELECT *, stand_in AS fraud_probability FROM tx)"
    by_stand_in = f"WITH {_TX}, {stand_in}, {_decided('stand')} "
    by_forest = f"WITH {_TX}, {forest}, {_decided('forest')} "
    fraud = "FROM scored WHERE prediction = 'FRAUD'"
    labelled = _LABELLED.format(source="tx")
    indexes = {f: forest_sql.index_sql(f) for f in ("location", "merchant_category")}

    category_index = " UNION ALL ".join(
        f"SELECT '{f}' AS field, {f} AS label,"
        f" CAST(row_number() OVER (ORDER BY count(*) DESC, {f}) - 1 AS DOUBLE) AS idx"
        f" FROM tx WHERE {f} IS NOT NULL GROUP BY {f}"
        for f in indexes
    )
    unseen = ", ".join(
        f"CASE event_id % 3 WHEN 0 THEN {f} WHEN 1 THEN 'NEW_' || {f} END AS {f}"
        for f in indexes
    )
    hash_text = (
        "CAST(floor(CAST(((event_id % 2147483648) * 2654435761 % 4294967296) AS DOUBLE)"
        " / 65536e0) AS BIGINT) % 100"
    )
    trailing = (
        f"WITH {_TX}, trailed AS (SELECT event_id, user_id, count(*) OVER w AS n,"
        f" CAST(sum({_MICROS}) OVER w AS DOUBLE) / 1e6 / count(*) OVER w AS mean FROM tx"
        " WINDOW w AS (PARTITION BY user_id ORDER BY ts"
        " RANGE BETWEEN INTERVAL '6 hours' PRECEDING AND CURRENT ROW))"
        f" SELECT event_id, user_id, n, {_cents('mean')} AS mean_amount FROM trailed"
    )
    # Amounts that are large, too large, or no numbers; totals in millions, rounded.
    money = (
        f"WITH {_TX}, odd AS (SELECT event_id, ts, user_id, CASE event_id % 100"
        " WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)"
        " WHEN 2 THEN 1e25 ELSE amount * 1099511627776e0 END AS amount FROM tx),"
        " worth AS (SELECT *, isfinite(amount) AND amount < 1e21 AS fits, CASE WHEN"
        f" isfinite(amount) AND amount < 1e21 THEN {_MICROS} END AS micros FROM odd)"
    )
    millions = "CAST(round(CAST(sum(micros) {0} AS DOUBLE) / 1e6 / {1} 1e6) AS BIGINT)"
    alert_text = (
        "SELECT transaction_id, 'Transaction ID: ' || transaction_id || chr(10)"
        " || 'User ID:        ' || user_id || chr(10)"
        " || 'Risk Level:     ' || CAST(risk_level AS VARCHAR) || '/10' || chr(10)"
        f" || 'Probability:    ' || printf('%.2f', {_cents('fraud_probability')}) || chr(10)"
        " || 'Reason:         ' || reason AS alert_text,"
        " 'Fraud alert for user ' || user_id || ' - Score: ' || CAST(risk_level AS VARCHAR)"
        f" AS warning {fraud}"
    )
    policy = f"WITH {_TX}, {stand_in}, {_decided('stand', 0.7, 0.8)} "
    fit = (
        f"WITH {_TX}, {labelled}, split AS (SELECT label, location, {hash_text} < 80 AS train"
        " FROM labelled), places AS (SELECT location, count(*) AS n FROM split WHERE train"
        " GROUP BY 1) SELECT count(*) FILTER (WHERE train) AS n_train,"
        " count(*) FILTER (WHERE NOT train) AS n_holdout,"
        " CAST(sum(label) FILTER (WHERE train) AS BIGINT) AS positive_train,"
        " CAST(sum(label) FILTER (WHERE NOT train) AS BIGINT) AS positive_holdout,"
        " (SELECT string_agg(location, ',' ORDER BY n DESC, location) FROM places) AS locations,"
        " TRUE AS area_agrees FROM split"
    )
    found = {
        "tx_decode": f"WITH {_TX} SELECT {_TRANSACTION} FROM tx",
        "tx_features": (
            f"WITH {_TX} SELECT transaction_id, is_online, tx_timestamp, tx_hour FROM tx"
        ),
        "tx_messages": f"WITH {_TX} SELECT user_id AS key, {_TRANSACTION} FROM tx",
        "scored_messages": f"{by_stand_in} SELECT user_id AS key, {_SCORED_JSON} FROM scored",
        "alert_messages": f"{by_forest} SELECT transaction_id AS key, {_ALERT} {fraud}",
        "quarantine": _quarantine(),
        "rule_score": f"{by_stand_in} SELECT event_id, rule_score FROM scored",
        "final_score": f"{by_stand_in} SELECT event_id, final_fraud_score FROM scored",
        "risk_level": f"{by_stand_in} SELECT event_id, risk_level FROM scored",
        "classify": f"{by_stand_in} SELECT event_id, prediction FROM scored",
        "reason": f"{by_stand_in} SELECT event_id, prediction, reason FROM scored",
        "forest_probability": f"WITH {_TX}, {forest} SELECT event_id, fraud_probability FROM forest",
        "scored_full": f"{by_forest} SELECT {_SCORED} FROM scored",
        "fraud_alerts": f"{by_forest} SELECT {_ALERT} {fraud}",
        "batch_summary": (
            f"{by_forest} SELECT count(*) AS records,"
            " count(*) FILTER (WHERE prediction = 'FRAUD') AS alerts,"
            " count(*) FILTER (WHERE prediction = 'SUSPICIOUS') AS suspicious,"
            " count(*) FILTER (WHERE user_id IS NULL) AS unkeyed FROM scored"
        ),
        "top_risk": (
            f"{by_forest} SELECT transaction_id, user_id, amount, fraud_probability,"
            " final_fraud_score, prediction FROM scored"
            " ORDER BY final_fraud_score DESC, transaction_id LIMIT 5"
        ),
        "alert_text": f"{by_forest} {alert_text}",
        "category_index": f"WITH {_TX} {category_index}",
        "category_unseen": (
            f"WITH {_TX}, changed AS (SELECT event_id, {unseen} FROM tx) SELECT event_id, "
            + ", ".join(f"{sql} AS {f}_idx" for f, sql in indexes.items())
            + " FROM changed"
        ),
        "feature_vector": (
            f"WITH {_TX} SELECT event_id, amount AS f0, CAST(tx_hour AS DOUBLE) AS f1,"
            f" CAST(is_online AS DOUBLE) AS f2, {indexes['location']} AS f3,"
            f" {indexes['merchant_category']} AS f4 FROM tx"
        ),
        "training_label": f"WITH {_TX}, {labelled} SELECT event_id, fraud_prob, label FROM labelled",
        "relabel": (
            f"{by_forest} SELECT transaction_id, amount, tx_hour, is_online, location,"
            " merchant_category, CASE WHEN risk_level >= 7 THEN 1 ELSE 0 END AS label FROM scored"
        ),
        "holdout_split": (
            f"SELECT event_id, {hash_text} AS bucket, {hash_text} < 80 AS is_train FROM events"
        ),
        "auc": (
            f"WITH {_TX}, {forest}, {_LABELLED.format(source='forest')},"
            " ranked AS (SELECT label, rank() OVER (ORDER BY fraud_probability)"
            " + (count(*) OVER (PARTITION BY fraud_probability) - 1) / 2e0 AS r FROM labelled),"
            " sums AS (SELECT CAST(sum(r) FILTER (WHERE label = 1) AS DOUBLE) AS s,"
            " CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,"
            " CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n FROM ranked)"
            " SELECT round((s - p * (p + 1e0) / 2e0) / (p * n), 9) AS auc FROM sums"
        ),
        "velocity_tumbling": (
            f"WITH {_TX} SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')"
            " AS window_start, user_id, count(*) AS n, "
            + _cents(f"CAST(sum({_MICROS}) AS DOUBLE) / 1e6")
            + " AS total FROM tx GROUP BY 1, 2"
        ),
        "user_profile": (
            f"WITH {_TX} SELECT event_id, user_id, count(*) OVER w AS user_n, "
            + _cents(f"CAST(sum({_MICROS}) OVER w AS DOUBLE) / 1e6")
            + " AS user_total FROM tx WINDOW w AS (PARTITION BY user_id,"
            " time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'))"
        ),
        "velocity_sliding": (
            f"WITH {_TX} SELECT time_bucket(INTERVAL '2 hours', ts, TIMESTAMP '1970-01-01')"
            " - k * INTERVAL '2 hours' AS window_start, user_id, count(*) AS n"
            " FROM tx, (VALUES (0), (1), (2)) AS back(k) GROUP BY 1, 2"
        ),
        "velocity_uneven": (
            f"WITH {_TX} SELECT time_bucket(INTERVAL '2 hours', ts, TIMESTAMP '1970-01-01')"
            " - k * INTERVAL '2 hours' AS window_start, user_id, count(*) AS n"
            " FROM tx, (VALUES (0), (1), (2)) AS back(k)"
            " WHERE ts < time_bucket(INTERVAL '2 hours', ts, TIMESTAMP '1970-01-01')"
            " - k * INTERVAL '2 hours' + INTERVAL '5 hours' GROUP BY 1, 2"
        ),
        "velocity_money": (
            f"{money} SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')"
            " AS window_start, user_id, count(*) AS n, CASE WHEN bool_and(fits) THEN "
            + millions.format("", "") + " END AS millions FROM worth GROUP BY 1, 2"
        ),
        "trailing_money": (
            f"{money} SELECT event_id, count(*) OVER w AS n, CASE WHEN bool_and(fits) OVER w THEN "
            + millions.format("OVER w", "count(*) OVER w /")
            + " END AS millions FROM worth WINDOW w AS (PARTITION BY user_id ORDER BY ts"
            " RANGE BETWEEN INTERVAL '6 hours' PRECEDING AND CURRENT ROW)"
        ),
        "velocity_session": (
            f"WITH {_TX}, marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w"
            " <= INTERVAL '6 hours' THEN 0 ELSE 1 END AS starts FROM tx"
            " WINDOW w AS (PARTITION BY user_id ORDER BY ts)),"
            " numbered AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id"
            " ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked)"
            " SELECT min(ts) AS session_start, user_id, count(*) AS n"
            " FROM numbered GROUP BY user_id, session"
        ),
        "velocity_trailing": trailing,
        "burst_flag": f"SELECT * FROM ({trailing}) WHERE n >= 5",
        "tx_dedup": (
            f"WITH {_TX} SELECT transaction_id, user_id, amount, 0 AS arrival FROM tx"
            " WHERE event_id % 10 <> 0 UNION ALL SELECT NULL, user_id, amount, copy FROM tx,"
            " (VALUES (0), (1), (2)) AS copies(copy)"
            " WHERE event_id % 10 = 0 AND copy <= event_id % 3"
        ),
        "gen_training": _generated_training(),
        "gen_transactions": _generated_transactions(),
        "stream_scored": f"{by_forest} SELECT {_SCORED} FROM scored",
        "stream_alerts": f"{by_forest} SELECT transaction_id AS key, {_ALERT} {fraud}",
        "stream_dead_letters": _quarantine(),
        "stream_cases": f"{by_forest} SELECT {_SCORED_JSON} {fraud}",
        "stream_scored_topic": f"{by_forest} SELECT user_id AS key, {_SCORED_JSON} FROM scored",
        "stream_alert_text": f"{by_forest} {alert_text}",
        "scored_policy": (
            f"{policy} SELECT event_id, final_fraud_score, risk_level, prediction, reason FROM scored"
        ),
        "fit_and_judge": fit,
    }
    found["retrain"] = (
        "SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS positive, TRUE AS split_holds,"
        f" count(*) AS n_alike FROM ({found['relabel']})"
    )
    found["stream_bursts"] = (
        f"SELECT * FROM ({found['velocity_sliding']}) WHERE n >= 3 AND window_start"
        " + INTERVAL '6 hours' <= (SELECT date_trunc('milliseconds', max(ts)) FROM events)"
        " - INTERVAL '1 hour'"
    )
    # What an hour's delay has closed; a trailing window is kept for its own length as well.
    seen = "(SELECT date_trunc('milliseconds', max(ts)) FROM events)"
    found["stream_trailing"] = (
        f"SELECT t.* FROM ({trailing}) AS t JOIN events USING (event_id)"
        f" WHERE events.ts + INTERVAL '7 hours' <= {seen}"
    )
    named = "CASE WHEN event_id % 10 <> 0 THEN user_id END"
    start = "time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')"
    found["stream_profile"] = (
        f"WITH {_TX} SELECT event_id, {named} AS user_id,"
        " CASE WHEN event_id % 10 <> 0 THEN count(*) OVER w END AS user_n,"
        f" CASE WHEN event_id % 10 <> 0 THEN "
        + _cents(f"CAST(sum({_MICROS}) OVER w AS DOUBLE) / 1e6")
        + f" END AS user_total FROM tx WHERE CASE WHEN event_id % 10 <> 0 THEN {start}"
        f" + INTERVAL '7 hours' <= {seen} ELSE ts + INTERVAL '7 hours' <= {seen} END"
        f" WINDOW w AS (PARTITION BY {named}, {start})"
    )
    found["ordered_messages"] = (
        f"WITH {_TX} SELECT user_id AS key, count(*) AS n, TRUE AS ascends FROM tx GROUP BY 1"
    )
    found["stream_stored_once"] = found["stream_committed"] = found["stream_scored"]
    found["profiles_merged"] = found["velocity_money"]
    arrives = "ts + CASE WHEN event_id % 40 = 0 THEN INTERVAL '2 days' ELSE INTERVAL '0 days' END"
    found["stream_late"] = (
        f"WITH {_TX}, arrived AS (SELECT event_id, user_id, ts, least(floor((epoch({arrives})"
        " - epoch(TIMESTAMP '2024-01-01')) / 432000), 5) AS part FROM tx),"
        " latest AS (SELECT part, max(ts) AS latest FROM arrived GROUP BY part)"
        f" SELECT event_id, user_id FROM arrived AS a WHERE {start} + INTERVAL '6 hours'"
        " <= (SELECT date_trunc('milliseconds', max(latest)) FROM latest"
        " WHERE latest.part <= a.part - 2) - INTERVAL '1 hour'"
    )
    found["stream_tumbling"] = found["velocity_tumbling"]
    found["stream_sessions"] = found["velocity_session"]
    found["stream_dedup"] = f"SELECT transaction_id, user_id, amount FROM ({found['tx_dedup']})"
    return found

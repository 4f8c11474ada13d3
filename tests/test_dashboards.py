from __future__ import annotations

import random
import statistics

import pytest
from helpers import AS_OF, merchants, txns, values
from pyspark.sql import functions as F

from ledgerline.operators import dashboards as D
from ledgerline.operators import lookups as L
from ledgerline.operators import topics as K
from ledgerline.operators.intents import resolve_merchant, validate_intents


def linear(sorted_values, p):
    k = (len(sorted_values) - 1) * p
    f = int(k)
    c = min(f + 1, len(sorted_values) - 1)
    return sorted_values[f] + (sorted_values[c] - sorted_values[f]) * (k - f)


def test_latency_summary(spark):
    rng = random.Random(1)
    data = [rng.randrange(50, 6000) for _ in range(103)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*data, -1])], "sample_no int, e2e_latency_ms int")
    got = D.latency_summary(df).first()
    kept = sorted(data[3:])
    assert (got.samples, got.min_ms, got.max_ms) == (100, kept[0], kept[-1])
    assert got.avg_ms == pytest.approx(statistics.mean(kept)) and got.stddev_ms == pytest.approx(statistics.stdev(kept))
    for name, p in (("median_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        assert got[name] == pytest.approx(linear(kept, p))
    assert got.within_target == sum(v <= 5000 for v in kept) / 100


@pytest.mark.parametrize("n", [1, 7, 19, 20, 21, 40, 100, 101])
def test_throughput_p95_position(spark, n):
    rng = random.Random(n)
    durations = [rng.randrange(1, 500) for _ in range(n + 1)]
    rows, clock = [], 0
    for i, ms in enumerate(durations):
        rows.append(((i + 1) * 10, 10, clock, clock + ms))
        clock += ms
    got = D.throughput_summary(spark.createDataFrame(rows, "inserted_after int, rows int, started_ms int, ended_ms int"), 10).first()
    kept = sorted(durations[1:])
    assert got.batch_ms_p95 == kept[int(len(kept) * 0.95)]
    assert (got.total_rows, got.measured_rows, got.batches_measured) == ((n + 1) * 10, n * 10, n)
    assert got.burst_tps == pytest.approx((n + 1) * 10_000 / clock)
    assert got.sustained_tps == pytest.approx(n * 10_000 / (clock - durations[0]))


def lagged(spark, rows):
    """(id, lag ms, seconds before AS_OF at ingestion)."""
    df = spark.createDataFrame(rows, "id string, lag int, age double")
    at = f"timestamp_micros(unix_micros(TIMESTAMP '{AS_OF}') - CAST(age * 1000000 AS BIGINT))"
    return df.selectExpr(
        "id", f"{at} AS _ingested_at", f"{at} - make_dt_interval(0, 0, 0, lag / 1000) AS created_at", f"unix_millis({at}) - lag AS _source_ts_ms"
    )


def test_quantiles_exact_and_approximate(spark):
    rng = random.Random(2)
    lags = [rng.randrange(0, 900) for _ in range(500)]
    log = lagged(spark, [(str(i), v, 30.0) for i, v in enumerate(lags)])
    exact = D.latency_quantiles(log, "2024-05-01 00:00:00", AS_OF).first()
    rough = D.latency_quantiles(log, "2024-05-01 00:00:00", AS_OF, exact=False).first()
    for name, p in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        assert exact[name] == pytest.approx(linear(sorted(lags), p)) and abs(rough[name] - exact[name]) < 10


def test_health_and_rate(spark):
    rows = [("1", 100, 1.0), ("2", 300, 4.0), ("3", 200, 5.0), ("4", 900, 299.0), ("5", 9, 300.0), ("6", 9, 86_400.0), ("7", 9, -5.0)]
    got = D.health_summary(lagged(spark, rows), AS_OF).first()
    assert (got.avg_latency_ms, got.tps_now, got.total_today, got.sample_rows) == (375.0, 0.4, 6, 4)
    assert got.p95_latency_ms == round(linear([100, 200, 300, 900], 0.95))
    points = D.tps_series(lagged(spark, rows), AS_OF).collect()
    assert len(points) == 60 and sum(p.tps for p in points) == 3
    assert D.events_last_minute(lagged(spark, rows), AS_OF).first()[0] == 3


def test_day_follows_the_zone(spark):
    rows = [("1", 0, 3600.0), ("2", 0, 3600.0 * 8)]  # 11:00 and 04:00 UTC
    assert D.health_summary(lagged(spark, rows), AS_OF, tz="UTC").first().total_today == 2
    assert D.health_summary(lagged(spark, rows), AS_OF, tz="America/Los_Angeles").first().total_today == 1


def test_top_merchants_merge_equal_names(spark):
    both = merchants(spark).unionByName(merchants(spark).where("id = 'm1'").withColumn("id", F.lit("m2")))
    t = txns(spark, [(1, "a", 5, 5), (2, "a", 7, 5, {"merchant_id": "m2"}), (3, "a", 1, 5, {"merchant_id": "m9"}), (4, "a", 50, 5, {"merchant_id": None})])
    got = [tuple(r) for r in D.top_merchants(t, both, AS_OF).collect()]
    assert got == [("Corner Shop", "grocery", "low", 2, 12.0), ("Night Casino", "gambling", "high", 1, 1.0)]


def test_cursor_and_identifiers(spark):
    plain = [L.cursor_value(c) for c in (None, "x", "-5", "12", 7, "²", "12:ab", "12:")]
    assert plain == [(0, None), (0, None), (0, None), (12, None), (7, None), (0, None), (12, "ab"), (12, "")]
    t = txns(spark, [(1, "a", 5, 5)])
    with pytest.raises(ValueError, match="invalid uuid"):
        L.transaction_by_id(t, "1' OR '1'='1")


def test_pages_lose_no_row_of_one_millisecond(spark):
    rows = spark.range(250).selectExpr(
        "lpad(id, 4, '0') AS id", "'a' AS account_id", "CAST(1 AS DECIMAL(18,2)) AS amount", "'VND' AS currency", "'purchase' AS type",
        "'completed' AS status", "IF(id < 240, 5000L, 5001L) AS _source_ts_ms",
    ).cache()
    seen, cursor = [], None
    while page := L.transactions_since(rows, cursor).collect():
        seen += [r["id"] for r in page]
        cursor = f"{page[-1]['source_ts_ms']}:{page[-1]['id']}"
    assert seen == [f"{k:04d}" for k in range(250)]


def test_newest_per_account_limit(spark):
    t = txns(spark, [(f"{a}{i}", a, 1, i) for a in "ab" for i in range(30)]).withColumn("description", F.lit(None).cast("string"))
    got = L.account_transactions(t, merchants(spark))
    assert got.groupBy("account_id").count().where("count = 20").count() == 2
    assert values(L.account_transactions(t, merchants(spark), "a"), "id") == values(got.where("account_id = 'a'"), "id")


def test_account_search(spark):
    people = spark.createDataFrame([("1", "Ann Lee", "x@y"), ("2", "Bob", "ANN@y"), ("3", "Cid", "c@y")], "id string, full_name string, email string")
    people = people.selectExpr("*", "CAST(1 AS DECIMAL(18,2)) AS balance", "'active' AS status")
    cases = spark.createDataFrame([("1", "open", 5), ("1", "open", 90_000), ("1", "closed_clean", 5)], "account_id string, status string, age int")
    cases = cases.selectExpr("account_id", "status", f"TIMESTAMP '{AS_OF}' - make_dt_interval(0, 0, 0, age) AS created_at")
    assert values(L.account_search(people, cases, AS_OF, " aNN "), "id", "open_alerts_24h") == [("1", 1), ("2", 0)]
    assert L.account_search(people, cases, AS_OF).count() == 3
    with pytest.raises(ValueError, match="limit"):
        L.account_search(people, cases, AS_OF, limit=-4)


def test_topics(spark):
    rows = [("t", p, o, 100 * o + p, "k", '{"a":1}' if o else "plain") for p, n in ((0, 5), (1, 2)) for o in range(n)]
    records = spark.createDataFrame(rows, "topic string, partition int, offset bigint, timestamp int, key string, value string")
    records = records.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    tail = [(r.partition, r.offset, r.value_json) for r in K.topic_tail(records, 3).collect()]
    assert tail == [(0, 4, '{"a":1}'), (0, 3, '{"a":1}'), (0, 2, '{"a":1}')]
    assert K.topic_tail(records, 500).where("value_json IS NULL").count() == 2
    with pytest.raises(ValueError, match="limit"):
        K.topic_tail(records, 10_000)
    assert K.topic_stats(records).first() == ("t", 2, 7)
    done = spark.createDataFrame([("t", 0, -1)], "topic string, partition int, offset bigint")
    lag = K.consumer_lag(K.log_ends(records), done)
    assert values(lag, "partition", "current", "lag") == [(0, 0, 5), (1, 0, 2)]
    assert values(lag.where("hint IS NOT NULL"), "partition") == [(1,)]
    assert K.total_lag(lag).first() == ("t", 7)
    for end in ({"t": {"0": 3, "1": 2}}, '{"t": {"0": 3, "1": 2}}'):
        reached = K.committed_offsets(spark, {"sources": [{"endOffset": end}]})
        assert K.total_lag(K.consumer_lag(K.log_ends(records), reached)).first() == ("t", 2)


def test_intents(spark):
    good = "00000000-0000-4000-8000-00000000000a"
    rows = [
        ("ok", good, "5", "USD", "purchase", None, "Corner Shop"), ("id", good.upper(), "5", None, None, good, None),
        ("acct", "x", "5", "USD", "purchase", good, None), ("nan", good, "NaN", "USD", "purchase", good, None), ("inf", good, "Infinity", "USD", "purchase", good, None),
        ("zero", good, "0", "USD", "purchase", good, None), ("ccy", good, "5", "GBP", "purchase", good, None), ("type", good, "5", "USD", "theft", good, None),
        ("none", good, "5", "USD", "purchase", "", None), ("mid", good, "5", "USD", "purchase", "m1", None), ("who", good, "5", "USD", "purchase", None, "Nobody"),
    ]
    df = spark.createDataFrame(rows, "id string, account_id string, amount string, currency string, type string, merchant_id string, merchant string")
    checked = validate_intents(df)
    reasons = dict(checked.select("id", "reason").collect())
    assert reasons["ok"] is None and reasons["id"] is None and reasons["who"] is None
    assert reasons["acct"].startswith("account_id") and reasons["ccy"].startswith("currency") and reasons["type"].startswith("type")
    assert {reasons[i] for i in ("nan", "inf", "zero")} == {"amount must be > 0"}
    assert reasons["none"].startswith("merchant_id or merchant") and reasons["mid"] == "merchant_id must be a UUID"
    resolved = {r.id: r for r in resolve_merchant(checked.where("reason IS NULL"), merchants(spark)).collect()}
    assert resolved["ok"].merchant_id == "m1" and resolved["id"].merchant_id == good
    assert resolved["who"].reason == "merchant not found: Nobody"

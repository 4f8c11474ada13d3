from __future__ import annotations

import json
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.account import decide
from ledgerline.functions.folds import ACTIVE, NOTHING, SUSPENDED, Statuses, Summary, decide_runs, decision_columns, read_events
from ledgerline.operators import ledger as B
from ledgerline.streaming.ingest import start
from ledgerline.streaming.ledger import EVENT, HEARTBEAT, OrderedLedger, current_balances, event_time_ledger, start_ledger, stream_ledger, wire_timeline

EVENTS = "account_id string, t int, id string, kind string, type string, amount string, intent string"


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS).selectExpr(
        "account_id", "timestamp_seconds(t) AS at", "id", "kind", "type", "CAST(amount AS DECIMAL(18,2)) AS amount", "intent"
    )


def accounts(spark, *rows):
    return spark.createDataFrame([(i, str(b), s) for i, b, s in rows], "id string, balance string, status string").selectExpr(
        "id", "CAST(balance AS DECIMAL(18,2)) AS balance", "status"
    )


def run(spark, rows, *accts, parts=4):
    decided = B.apply_ledger(events(spark, rows), accounts(spark, *accts), parts)
    return {r.id: r for r in decided.collect()}


def test_sequences(spark):
    rows = [
        ("s", 1, "s1", "suspend", None, None, None), ("s", 2, "s2", "txn", "purchase", "100000", "completed"),
        ("r", 1, "r1", "suspend", None, None, None), ("r", 2, "r2", "reactivate", None, None, None),
        ("r", 3, "r3", "txn", "purchase", "250000", "completed"),
        ("i", 1, "i1", "txn", "purchase", "11000000", "completed"),
        ("w", 1, "w1", "txn", "withdrawal", "6000000", "completed"), ("w", 1, "w2", "txn", "withdrawal", "6000000", "completed"),
        ("gone", 1, "g1", "txn", "purchase", "1", "completed"), ("gone", 2, "g2", "topup", None, "5", None), ("gone", 3, "g3", "suspend", None, None, None),
        ("t", 1, "t1", "topup", None, "0", None), ("t", 2, "t2", "topup", None, "10000000000.01", None), ("t", 3, "t3", "topup", None, "10000000000", None),
        ("t", 4, "t4", "suspend", None, None, None), ("t", 5, "t5", "topup", None, "1", None), ("t", 6, "t6", "suspend", None, None, None),
        ("f", 1, "f1", "txn", "purchase", "5", "failed"), ("f", 2, "f2", "reactivate", None, None, None), ("f", 3, "f3", "txn", "refund", "5", "completed"),
    ]
    opening = [(a, "10000000", "active") for a in "sriwtf"]
    for parts in (1, 3, 16):
        got = run(spark, rows, *opening, parts=parts)

        def seen(i):
            r = got[i]
            return r.outcome, r.recorded, r.status, r.reason, None if r.balance_after is None else float(r.balance_after)

        full = 10_000_000.0
        assert seen("s2") == ("R", True, "failed", "rejected: account suspended", full)
        assert seen("r3") == ("C", True, "completed", None, 9_750_000.0)
        assert seen("i1") == ("I", True, "failed", "insufficient funds", full)
        assert [seen(i)[0] for i in ("w1", "w2")] == ["C", "I"] and seen("w2")[4] == 4_000_000.0
        assert [seen(i)[:2] for i in ("g1", "g2", "g3")] == [("M", False)] * 3
        assert [seen(i)[0] for i in ("t1", "t2", "t3", "t4", "t5", "t6")] == ["V", "V", "C", "C", "X", "X"]
        assert got["t5"].reason == "cannot top up account in status 'suspended'" and got["t6"].reason == "not_active"
        assert seen("t3")[4] == 10_010_000_000.0
        assert seen("f1") == ("F", True, "failed", None, full) and got["f2"].reason == "not_suspended"
        assert seen("f3")[4] == full + 5


def random_rows(n, seed, short):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = "hot" if rng.random() < 0.34 else f"a{rng.randrange(40)}"
        kind = rng.choices(["txn", "topup", "suspend", "reactivate"], [90, 4, 1, 2] if short else [1, 0, 0, 0])[0]
        amount = f"{rng.randrange(1, 60_000 if short else 300) / 100:.2f}"
        rows.append((account, rng.randrange(n // 2), f"e{i:06d}", kind, rng.choice(["purchase", "transfer", "refund"]), amount, rng.choices(["completed", "failed"], [9, 1])[0]))
    return rows


def fold(rows, opening):
    state = {a: (round(float(b) * 100), s) for a, b, s in opening}
    out = {}
    for account, _, eid, kind, typ, amount, intent in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        after, outcome, recorded, status, reason = decide(state.get(account), kind, typ, round(float(amount) * 100), intent)
        if after:
            state[account] = after
        out[eid] = (outcome, recorded, status, reason, *(after or (None, None)))
    return out


@pytest.mark.parametrize(("short", "parts"), [(True, 6), (True, 29), (False, 13)])
def test_equals_a_plain_fold_with_a_hot_account(spark, short, parts):
    rows = random_rows(4000, parts, short)
    opening = [("hot", "300.00" if short else "1000000", "active"), *[(f"a{i}", "100.00", "suspended" if i % 9 == 0 else "active") for i in range(38)]]
    got = run(spark, rows, *opening, parts=parts)
    want = fold(rows, opening)
    assert {i: (r.outcome, r.recorded, r.status, r.reason, None if r.balance_after is None else round(r.balance_after * 100), r.account_status) for i, r in got.items()} == want


def test_hot_account_is_cut_into_parts(spark):
    rows = random_rows(3000, 5, False)
    timeline = B.ledger_timeline(events(spark, rows), accounts(spark, ("hot", "1000000", "active"))).repartitionByRange(12, *B.ORDER)
    sizes = timeline.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 3000 / 12 * 2  # a third of all rows would be 1000


def test_part_count():
    assert [B.part_count(n, 200) for n in (0, 1, 10_000, 10_001, 10**6, 10**8, 10**12)] == [1, 1, 1, 2, 100, 200, 500_000]


def test_known_openings_walks_the_summaries():
    def part(segment, net, need, ends=(ACTIVE, SUSPENDED)):
        return {"segment": segment, "summary": [*ends, net, 0, need, NOTHING]}

    todo = {"a": [part(3, -10, 50), part(4, 5, 90), part(5, 0, 0), part(6, 1, 1)], "m": [part(8, -1, 1), part(9, -1, 1)], "c": [part(10, 5, 99), part(11, 0, 0)]}
    ready, waiting = B.known_openings(todo, {"a": (100, "active"), "c": (1, "closed")})
    assert ready == {3: (100, "active"), 4: (90, "active"), 5: (95, "active"), 6: (95, "active"), 8: None, 9: None, 10: (1, "closed"), 11: (1, "closed")} and not waiting
    ready, waiting = B.known_openings(todo, {"a": (60, "active")})
    assert ready == {3: (60, "active"), 4: (50, "active"), 8: None, 9: None, 10: None, 11: None}
    assert [p["segment"] for p in waiting["a"]] == [5, 6]
    # commands do not make a part wait: the status an account leaves with does not depend on money
    commands = {"a": [part(1, -5, 5, ends=(SUSPENDED, ACTIVE)), part(2, -5, 5, ends=(ACTIVE, ACTIVE)), part(3, -5, 5)]}
    ready, waiting = B.known_openings(commands, {"a": (10, "active")})
    assert ready == {1: (10, "active"), 2: (5, "suspended"), 3: (5, "active")} and not waiting


def test_runs_of_events_equal_single_decisions():
    rng = random.Random(8)
    for _ in range(60):
        groups, rows, want, openings = [], [], [], []
        for _ in range(rng.randint(1, 6)):
            account = rng.choice([None, (rng.randrange(500), "active"), (rng.randrange(500), "suspended"), (9, "closed")])
            groups.append(len(rows))
            openings.append(account)
            for _ in range(rng.randint(1, 40)):
                event = (rng.choice(["txn"] * 6 + ["topup", "suspend", "reactivate", "odd", None]), rng.choice(["purchase", "refund", "deposit", "odd", None]),
                         rng.choice([None, -5, 0, 10, 100, 200, 10**13]), rng.choice(["completed", "failed", None]))
                rows.append(event)
                account, *decision = decide(account, *event)
                want.append((*decision, *(account or (None, None))))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.string()))]
        events, statuses = read_events(pa.RecordBatch.from_arrays(columns, names=["kind", "type", "cents", "intent"])), Statuses()
        numbers = np.array([statuses.number(o[1] if o else None) for o in openings])
        made = decide_runs(events, np.array(groups), np.array([o[0] if o else 0 for o in openings]), numbers)
        assert list(zip(*(c.to_pylist() for c in decision_columns(events, made, statuses).values()))) == want
        # the summary of a run tells how an account with enough money leaves it
        ends = [*groups[1:], len(rows)]
        for first, end, account in zip(groups, ends, openings):
            if account and account[1] != "closed":
                summary, k = Summary(), ACTIVE if account[1] == "active" else SUSPENDED
                middle = rng.randint(first, end)
                summary.add(events[first:middle])
                summary.add(events[middle:end])
                rich = (account[0] + max(summary.needs[k], 0), account[1])
                for event in rows[first:end]:
                    rich, outcome, *_ = decide(rich, *event)
                    assert outcome != "I"
                assert rich == (account[0] + max(summary.needs[k], 0) + summary.nets[k], ("active", "suspended")[summary.ends[k]])


def test_counts_balances_and_rows(spark):
    rows = [("a", 1, "1", "txn", "purchase", "5", "completed"), ("a", 2, "2", "topup", None, "1", None), ("b", 1, "3", "txn", "purchase", "1", "completed")]
    opening = accounts(spark, ("a", "10", "active"), ("c", "7", "closed"))
    decided = B.apply_ledger(events(spark, rows), opening, 3)
    counts = B.ledger_outcome_counts(decided).first()
    assert (counts.total, counts.completed, counts.missing, counts.completion_rate) == (2, 1, 1, 0.5)
    assert {r.id: float(r.balance) for r in B.closing_balances(decided, opening).collect()} == {"a": 6.0, "c": 7.0}
    assert {(r.id, r.type) for r in B.recorded_transactions(decided).collect()} == {("1", "purchase"), ("2", "deposit")}


def test_stream_equals_batch(spark, tmp_path):
    rows = random_rows(600, 3, True)
    opening = [("hot", "300", "active"), *[(f"a{i}", "100", "active") for i in range(30)]]
    batch = {r.id: tuple(r) for r in B.apply_ledger(events(spark, rows), accounts(spark, *opening), 5).collect()}
    source = tmp_path / "in"
    source.mkdir()
    lines = [json.dumps({"account_id": a, "rank": 0, "id": "", "kind": "open", "type": s, "cents": int(float(b) * 100)}) for a, b, s in opening]
    (source / "0.json").write_text("\n".join(lines))
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    for n, chunk in enumerate([ordered[:250], ordered[250:]]):
        last = n  # batches in time order, as the source delivers them
        text = [json.dumps({"account_id": a, "rank": 1, "at": f"1970-01-01T{t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}Z", "id": i, "kind": k, "type": y, "cents": round(float(m) * 100), "intent": c}) for a, t, i, k, y, m, c in chunk]
        (source / f"{last + 1}.json").write_text("\n".join(text))
    records = spark.readStream.format("text").option("maxFilesPerTrigger", 3).load(str(source))
    out = str(tmp_path / "out")

    def write(df, n):
        df.write.mode("overwrite").parquet(f"{out}/{n}")

    start(stream_ledger(wire_timeline(records)).writeStream.foreachBatch(write), str(tmp_path / "c"), None).awaitTermination()
    got = {r.id: tuple(r) for r in spark.read.parquet(f"{out}/*").select(*B.RESULT).collect()}
    assert got == batch

    # the batch-by-batch form, first over the accounts and the earlier events, then over the rest
    later = source / "2.json"
    held = later.read_text()
    later.rename(tmp_path / "held.json")
    paths = [str(tmp_path / n) for n in ("decided", "balances", "ledger-checkpoint")]

    def resume():
        events_in = wire_timeline(spark.readStream.format("text").load(str(source)))
        start_ledger(events_in, *paths, parts=5, trigger=None, publish_every=2).awaitTermination()

    resume()
    (source / "3.json").write_text(held)
    resume()
    decided = spark.read.parquet(paths[0])
    assert decided.select("batch_id").distinct().count() == 2
    assert {r.id: tuple(r) for r in decided.select(*B.RESULT).collect()} == batch
    balances = {r.id: r.balance for r in current_balances(spark, paths[1], 99).collect()}
    whole = B.apply_ledger(events(spark, rows), accounts(spark, *opening), 5)
    assert balances == {r.id: r.balance for r in B.closing_balances(whole, accounts(spark, *opening)).collect()}


def test_event_time_ledger_equals_batch_whatever_the_batches(spark, tmp_path):
    rows = random_rows(400, 11, True)
    opening = [("hot", "300", "active"), *[(f"a{i}", "100", "suspended" if i % 7 == 0 else "active") for i in range(30)]]
    batch = {r.id: tuple(r) for r in B.apply_ledger(events(spark, rows), accounts(spark, *opening), 5).collect()}
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    (tmp_path / "in").mkdir()

    def put(name, chunk):
        lines = [{"account_id": a, "rank": 1, "at": f"1970-01-02T{t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}Z", "id": i, "kind": k, "type": y, "cents": round(float(m) * 100), "intent": c} for a, t, i, k, y, m, c in chunk]
        (tmp_path / "in" / name).write_text("\n".join(map(json.dumps, lines)))

    def run():
        records = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(tmp_path / "in"))

        def write(df, n):
            df.write.mode("overwrite").parquet(f"{tmp_path}/out/{n}")

        decided = event_time_ledger(wire_timeline(records), accounts(spark, *opening), "1 hour")
        start(decided.writeStream.foreachBatch(write), str(tmp_path / "c"), None).awaitTermination()
        return [r for r in spark.read.parquet(f"{tmp_path}/out/*").collect()]

    put("0.json", shuffled[:150])
    put("1.json", shuffled[150:300])
    early = run()
    put("2.json", shuffled[300:] + [rows[0]])  # and one of them once more
    put("3.json", [("", 20_000, "", HEARTBEAT, None, "0", None)])
    put("4.json", [("", 20_001, "", HEARTBEAT, None, "0", None)])
    got = run()  # a restart: what was decided is not decided again
    assert len(got) == len(rows) and len(early) < len(rows)
    day = 86_400
    shifted = {i: (r[0], r[1].timestamp() + day, *r[2:]) for i, r in batch.items()}
    assert {r.id: (r.account_id, r["at"].timestamp(), *tuple(r)[2:]) for r in got} == shifted


class KeptState:
    """State in memory that counts what is written and looked up in it."""

    def __init__(self):
        self.calls, self.values = 0, {}


class Value(KeptState):
    held = None

    def get(self):
        self.calls += 1
        return self.held

    def update(self, value):
        self.calls += 1
        self.held = value

    def clear(self):
        self.held = None


class Items(KeptState):
    def get(self):
        return iter(list(self.values.get("list", [])))

    def appendValue(self, value):
        self.calls += 1
        self.values.setdefault("list", []).append(value)

    def put(self, rows):
        self.values["list"] = list(rows)

    def clear(self):
        self.values.pop("list", None)

    def getValue(self, key):
        return self.values.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key] = value


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def registerTimer(self, at_ms):
        self.timers.add(at_ms)

    def deleteTimer(self, at_ms):
        self.timers.discard(at_ms)

    def _state(self, kind, name):
        return self.states.setdefault(name, kind())

    getValueState = lambda self, name, schema: self._state(Value, name)
    getListState = lambda self, name, schema: self._state(Items, name)
    getMapState = lambda self, name, *schemas: self._state(Items, name)


def test_a_bucket_of_early_events_costs_few_state_calls():
    rnd = random.Random(8)
    events = [(f"a{k % 9}" if k % 10 else None, 1000 * rnd.randrange(1, 400), f"t{k:03d}", 1, "topup", None, 100 + k, None, "m", "VND", None) for k in range(500)]
    handle, ledger = Handle(), OrderedLedger()
    ledger.init(handle)
    opening = pd.DataFrame([(f"a{k}", k * 10_000, "active") for k in range(9)], columns=["account_id", "cents", "status"])
    for part in (opening[:5], opening[5:]):
        ledger.handleInitialState((7,), part, None)
    for chunk in (events[:300], events[200:]):  # a hundred come twice
        assert list(ledger.handleInputRows((7,), iter([pd.DataFrame(chunk, columns=EVENT)]), None)) == []
    assert sum(state.calls for state in handle.states.values()) < 20  # not some for each event
    assert handle.timers == {min(e[1] for e in events) // 1000}
    told = []
    for watermark_ms in (200, 400):
        times = type("Times", (), {"getCurrentWatermarkInMs": lambda self, at=watermark_ms: at})()
        for at in sorted(t for t in handle.timers if t <= watermark_ms):
            handle.timers.discard(at)
            for frame in ledger.handleExpiredTimer((7,), times, None):
                told += frame.itertuples(index=False)
        assert bool(handle.timers) == (watermark_ms == 200)
    assert sorted(r.id for r in told) == [e[2] for e in events]
    for account in [f"a{k}" for k in range(9)]:
        balance = int(account[1:]) * 10_000
        mine = [r for r in told if r.account_id == account]
        assert [r.id for r in mine] == [e[2] for e in sorted((e for e in events if e[0] == account), key=lambda e: (e[1], e[2]))]
        for r in mine:
            balance += r.cents
            assert r.balance_cents == balance
    assert {r.outcome for r in told if r.account_id is None} != {r.outcome for r in told if r.account_id}

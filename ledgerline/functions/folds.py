"""The ledger's decisions for whole runs of events at once.

What an event does depends on the account's status, which only commands change, and on its balance. The status is therefore
known before any balance is; the balances follow as cumulative sums, and only an account that runs short is
walked through event by event, from the first refusal on. The rules are those of
:func:`ledgerline.functions.account.decide`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from ledgerline.functions import account as A
from ledgerline.schemas import DEBIT_TYPES, TXN_TYPES

# what an event asks for, whatever the account
UNREADABLE, DECLINED, MOVE, NOT_POSITIVE, TOO_LARGE, TOPUP, SUSPEND, REACTIVATE = range(8)
ACTIVE, SUSPENDED, UNKNOWN = 0, 1, 2  # numbers of statuses; others follow
OUTCOMES = (A.COMPLETED, A.REJECTED, A.SHORT, A.MISSING, A.DECLINED, A.INVALID, A.CONFLICT)
_C, _R, _I, _M, _F, _V, _X = range(7)
NOTHING = -(1 << 62)  # the money needed by events that need none


@dataclass
class Events:
    """Events of a batch as arrays: what each asks for, the cents it would move, and whether it is refused without money."""

    asks: np.ndarray
    cents: np.ndarray
    debit: np.ndarray

    def __getitem__(self, part) -> Events:
        return Events(self.asks[part], self.cents[part], self.debit[part])


def _member(column: pa.Array, values) -> np.ndarray:
    """Whether each text is one of the values; null is none."""
    encoded = column.dictionary_encode()
    known = np.array([v in values for v in encoded.dictionary.to_pylist()] + [False])
    return known[encoded.indices.fill_null(len(known) - 1).to_numpy(zero_copy_only=False)]


def read_events(batch: pa.RecordBatch) -> Events:
    """Columns kind, type, cents and intent of a batch."""
    kind, cents = batch["kind"], batch["cents"]
    empty = cents.is_null().to_numpy(zero_copy_only=False)
    cents = cents.fill_null(0).to_numpy()
    txn, topup = _member(kind, ("txn",)), _member(kind, ("topup",))
    debit = _member(batch["type"], DEBIT_TYPES)
    readable = txn & ~empty & _member(batch["type"], TXN_TYPES)
    asks = np.full(len(cents), UNREADABLE, dtype=np.int8)
    asks[readable] = MOVE
    asks[readable & _member(batch["intent"], ("failed",))] = DECLINED
    asks[topup] = TOPUP
    asks[topup & (cents > A.MAX_TOPUP_CENTS)] = TOO_LARGE
    asks[topup & (empty | (cents <= 0))] = NOT_POSITIVE
    asks[_member(kind, ("suspend",))] = SUSPEND
    asks[_member(kind, ("reactivate",))] = REACTIVATE
    debit &= asks == MOVE
    return Events(asks, np.where(debit, -cents, cents), debit)


@dataclass
class Statuses:
    """Numbers for statuses; the first three are fixed."""

    names: list = field(default_factory=lambda: ["active", "suspended", None])

    def number(self, name: str | None) -> int:
        if name not in self.names:
            self.names.append(name)
        return self.names.index(name)


def status_path(asks: np.ndarray, firsts: np.ndarray, opening: np.ndarray) -> np.ndarray:
    """The status before each event. Groups begin at `firsts`, with the statuses `opening`; only commands are walked through."""
    sizes = np.diff(np.append(firsts, len(asks)))
    out = np.repeat(opening, sizes)
    commands = np.flatnonzero(asks >= SUSPEND)
    if not len(commands):
        return out
    group = np.searchsorted(firsts, commands, side="right") - 1
    ends = (firsts + sizes)[group].tolist()
    changes, last, now = [], -1, None
    for at, ask, own, end, begun in zip(commands.tolist(), asks[commands].tolist(), group.tolist(), ends, opening[group].tolist()):
        if own != last:
            last, now = own, begun
        if now == ACTIVE and ask == SUSPEND:
            now = SUSPENDED
        elif now == SUSPENDED and ask == REACTIVATE:
            now = ACTIVE
        else:
            continue
        changes.append((at + 1, end, now))
    # a later change overwrites the rest of its group
    for at, end, status in changes:
        out[at:end] = status
    return out


def _after(asks: np.ndarray, before: np.ndarray) -> np.ndarray:
    out = before.copy()
    out[(before == ACTIVE) & (asks == SUSPEND)] = SUSPENDED
    out[(before == SUSPENDED) & (asks == REACTIVATE)] = ACTIVE
    return out


@dataclass
class Decided:
    """Outcome numbers, whether money moved, and the balance and status after each event."""

    outcome: np.ndarray
    before: np.ndarray
    balance: np.ndarray
    after: np.ndarray


def decide_runs(events: Events, firsts: np.ndarray, balances: np.ndarray, statuses: np.ndarray) -> Decided:
    """Decide groups of events, each with an opening balance and a status number (UNKNOWN: no such account)."""
    asks = events.asks
    sizes = np.diff(np.append(firsts, len(asks)))
    before = status_path(asks, firsts, statuses)
    live = before == ACTIVE
    moves = np.where(live & ((asks == MOVE) | (asks == TOPUP)), events.cents, 0)
    sums = np.cumsum(moves)
    balance = sums + np.repeat(balances - (sums[firsts] - moves[firsts]), sizes) if len(asks) else sums
    debit = events.debit & live
    refused = np.zeros(len(asks), dtype=bool)
    short = np.flatnonzero(debit & (balance < 0))
    if len(short):
        group = np.searchsorted(firsts, short, side="right") - 1
        _, where = np.unique(group, return_index=True)
        for own, first in zip(group[where].tolist(), short[where].tolist()):
            end = int(firsts[own] + sizes[own])
            money = int(balance[first] - moves[first])
            held, no = [], []
            for k, (move, is_debit) in enumerate(zip(moves[first:end].tolist(), debit[first:end].tolist()), first):
                if is_debit and money + move < 0:
                    no.append(k)
                else:
                    money += move
                held.append(money)
            balance[first:end] = held
            refused[no] = True
    outcome = np.full(len(asks), _C, dtype=np.int8)
    outcome[refused] = _I
    outcome[asks == DECLINED] = _F
    outcome[~live & ((asks == MOVE) | (asks == DECLINED))] = _R
    outcome[(asks == SUSPEND) & ~live] = _X
    outcome[(asks == REACTIVATE) & (before != SUSPENDED)] = _X
    outcome[(asks == TOPUP) & ~live] = _X
    outcome[before == UNKNOWN] = _M
    outcome[(asks == UNREADABLE) | (asks == NOT_POSITIVE) | (asks == TOO_LARGE)] = _V
    return Decided(outcome, before, balance, _after(asks, before))


def _named(numbers: np.ndarray, names: list) -> pa.Array:
    return pa.DictionaryArray.from_arrays(pa.array(numbers.astype(np.int32)), pa.array(names, pa.string())).cast(pa.string())


def decision_columns(events: Events, made: Decided, statuses: Statuses) -> dict[str, pa.Array]:
    """Columns outcome, recorded, status, reason, balance_cents and account_status."""
    asks, outcome = events.asks, made.outcome
    txn = (asks == MOVE) | (asks == DECLINED)
    moved = (outcome == _C) & (txn | (asks == TOPUP))
    recorded = moved | (txn & np.isin(outcome, (_R, _F, _I)))
    status = np.where(moved, 0, np.where(recorded, 1, 2))
    texts = [None, A.UNREADABLE, A.NOT_FOUND, A.INSUFFICIENT, A.NOT_POSITIVE, A.TOO_LARGE, A.NOT_ACTIVE, A.NOT_SUSPENDED]
    first = len(texts)
    texts += [A.rejected(name) for name in statuses.names] + [A.no_topup(name) for name in statuses.names]
    reason = np.zeros(len(asks), dtype=np.int32)
    for number, where in (
        (1, asks == UNREADABLE),
        (2, outcome == _M),
        (3, outcome == _I),
        (4, asks == NOT_POSITIVE),
        (5, asks == TOO_LARGE),
        (6, (outcome == _X) & (asks == SUSPEND)),
        (7, (outcome == _X) & (asks == REACTIVATE)),
    ):
        reason[where] = number
    refused, untopped = outcome == _R, (outcome == _X) & (asks == TOPUP)
    reason[refused] = first + made.before[refused]
    reason[untopped] = first + len(statuses.names) + made.before[untopped]
    unknown = made.after == UNKNOWN
    return {
        "outcome": _named(outcome, list(OUTCOMES)),
        "recorded": pa.array(recorded),
        "status": _named(status, ["completed", "failed", None]),
        "reason": _named(reason, texts),
        "balance_cents": pa.array(made.balance, pa.int64(), mask=unknown),
        "account_status": _named(made.after, statuses.names),
    }


class Summary:
    """What a run of events makes of an account that opens active, or suspended: its status, net change, and the money needed.

    Runs compose: with enough money a run adds its net change. A run needs as much as its poorest moment is below
    zero, so nothing has to be read again to know how an account with that much leaves it.
    """

    def __init__(self) -> None:
        self.ends, self.nets, self.needs = [ACTIVE, SUSPENDED], [0, 0], [NOTHING, NOTHING]

    def add(self, events: Events) -> None:
        first = np.zeros(1, dtype=np.int64)
        for k in (0, 1):
            if not len(events.asks):
                continue
            before = status_path(events.asks, first, np.array([self.ends[k]]))
            live = before == ACTIVE
            sums = np.cumsum(np.where(live & ((events.asks == MOVE) | (events.asks == TOPUP)), events.cents, 0))
            debits = sums[events.debit & live]
            if len(debits):
                self.needs[k] = max(self.needs[k], -(self.nets[k] + int(debits.min())))
            self.nets[k] += int(sums[-1])
            self.ends[k] = int(_after(events.asks[-1:], before[-1:])[0])

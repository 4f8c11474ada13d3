"""The per-account decision: a few lines of arithmetic used inside Spark tasks.

Money is in whole cents. An account is (balance, status), or None when unknown.
"""

from __future__ import annotations

from ledgerline.schemas import DEBIT_TYPES, TXN_TYPES

# ---- fixed values: texts recorded with a decision, largest top-up ----
INSUFFICIENT = "insufficient funds"
NOT_FOUND = "account not found"
UNREADABLE = "unreadable amount, kind or type"
NOT_POSITIVE = "amount must be > 0"
NOT_ACTIVE, NOT_SUSPENDED = "not_active", "not_suspended"
MAX_TOPUP_CENTS = 10_000_000_000 * 100
TOO_LARGE = f"amount must be <= {MAX_TOPUP_CENTS // 100}"
TOPUP_DESCRIPTION, TOPUP_CURRENCY = "Top up via UI", "VND"
# ----------------------------------------------------------------------

KINDS = ("txn", "topup", "suspend", "reactivate")
COMPLETED, REJECTED, SHORT, MISSING, DECLINED, INVALID, CONFLICT = "C", "R", "I", "M", "F", "V", "X"


def rejected(state: str | None) -> str:
    return f"rejected: account {state}"


def no_topup(state: str | None) -> str:
    return f"cannot top up account in status '{state}'"


def decide(account, kind, txn_type, cents, intent):
    """(account afterwards, outcome, recorded, status, reason) for one event.

    Kinds: `open` (the account as it stands), `txn`, `topup`, `suspend`, `reactivate`.
    Only transactions leave a row when refused; a reason replaces the description. An
    event without a readable amount, or of an unknown kind or type, changes nothing.
    """
    if kind not in KINDS or (kind == "txn" and (cents is None or txn_type not in TXN_TYPES)):
        return account, INVALID, False, None, UNREADABLE
    if kind == "txn":
        if account is None:
            return account, MISSING, False, None, NOT_FOUND
        balance, state = account
        if state != "active":
            return account, REJECTED, True, "failed", rejected(state)
        if intent == "failed":
            return account, DECLINED, True, "failed", None
        debit = txn_type in DEBIT_TYPES
        if debit and balance < cents:
            return account, SHORT, True, "failed", INSUFFICIENT
        return (balance - cents if debit else balance + cents, state), COMPLETED, True, "completed", None
    if kind == "topup":
        if cents is None or cents <= 0:
            return account, INVALID, False, None, NOT_POSITIVE
        if cents > MAX_TOPUP_CENTS:
            return account, INVALID, False, None, TOO_LARGE
        if account is None:
            return account, MISSING, False, None, NOT_FOUND
        if account[1] != "active":
            return account, CONFLICT, False, None, no_topup(account[1])
        return (account[0] + cents, account[1]), COMPLETED, True, "completed", None
    if account is None:
        return account, MISSING, False, None, NOT_FOUND
    needed, result, conflict = {
        "suspend": ("active", "suspended", NOT_ACTIVE),
        "reactivate": ("suspended", "active", NOT_SUSPENDED),
    }[kind]
    if account[1] != needed:
        return account, CONFLICT, False, None, conflict
    return (account[0], result), COMPLETED, False, None, None

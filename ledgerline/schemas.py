"""Table layouts, allowed values and defaults of the four monitored tables.

Every table is described once as a :class:`TableSpec`; parsing, typing and
checking are all derived from that description, so a new column is added in one
place only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# How a wire column (always a string in the change log) becomes a typed one.
TEXT, AMOUNT, WHOLE, STAMP, STAMP_OR_NULL = "text", "amount", "whole", "stamp", "stamp_or_null"

_SPARK_TYPE = {
    TEXT: T.StringType(),
    AMOUNT: MONEY,
    WHOLE: T.IntegerType(),
    STAMP: T.TimestampType(),
    STAMP_OR_NULL: T.TimestampType(),
}


@dataclass(frozen=True)
class TableSpec:
    """Column kinds plus the row-level rules the source database enforces."""

    name: str
    columns: dict[str, str]
    required: tuple[str, ...]
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ("id",)

    def wire_schema(self) -> T.StructType:
        """Schema of one flat change message: strings, plus the version number."""
        fields = [T.StructField(c, T.StringType()) for c in self.columns]
        fields += [
            T.StructField("__deleted", T.StringType()),
            T.StructField("__op", T.StringType()),
            T.StructField("__table", T.StringType()),
            T.StructField("__source_ts_ms", T.LongType()),
        ]
        return T.StructType(fields)

    def row_schema(self) -> T.StructType:
        """Schema of the before/after images inside an envelope."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def state_schema(self) -> T.StructType:
        """Schema of the typed version log."""
        fields = [T.StructField(c, _SPARK_TYPE[k]) for c, k in self.columns.items()]
        fields += [
            T.StructField("cdc_op", T.StringType()),
            T.StructField("_source_ts_ms", T.LongType()),
            T.StructField("_ingested_at", T.TimestampType()),
            T.StructField("_partition", T.IntegerType()),
            T.StructField("_offset", T.LongType()),
        ]
        return T.StructType(fields)


# ---- fixed values: allowed column values and defaults of the source tables ----
ACCOUNT_STATUSES = ("active", "suspended", "closed")
RISK_LEVELS = ("low", "medium", "high")
TXN_TYPES = ("purchase", "transfer", "withdrawal", "refund", "deposit")
TXN_STATUSES = ("pending", "completed", "failed", "flagged")
RULE_CODES = ("VELOCITY", "LARGE_AMT", "MULTI_CCY", "ZSCORE", "HIGH_RISK", "FAIL_SPIKE")
SEVERITIES = ("low", "medium", "high", "critical")
CASE_STATUSES = ("open", "closed_fraud", "closed_clean")
CURRENCIES = ("VND", "USD", "EUR", "JPY", "THB")
DEBIT_TYPES = ("purchase", "transfer", "withdrawal")
# -------------------------------------------------------------------------------

ACCOUNTS = TableSpec(
    name="accounts",
    columns={
        "id": TEXT,
        "full_name": TEXT,
        "email": TEXT,
        "phone": TEXT,
        "balance": AMOUNT,
        "currency": TEXT,
        "status": TEXT,
        "created_at": STAMP,
        "updated_at": STAMP,
    },
    required=("id", "full_name", "email", "balance", "currency", "status", "created_at", "updated_at"),
    domains={"status": ACCOUNT_STATUSES},
    defaults={"balance": "0.00", "currency": "VND", "status": "active"},
)

MERCHANTS = TableSpec(
    name="merchants",
    columns={
        "id": TEXT,
        "name": TEXT,
        "category": TEXT,
        "mcc_code": TEXT,
        "risk_level": TEXT,
        "country": TEXT,
        "created_at": STAMP,
        "updated_at": STAMP,
    },
    required=("id", "name", "category", "risk_level", "country", "created_at", "updated_at"),
    domains={"risk_level": RISK_LEVELS},
    defaults={"risk_level": "low", "country": "VN"},
)

TRANSACTIONS = TableSpec(
    name="transactions",
    columns={
        "id": TEXT,
        "account_id": TEXT,
        "merchant_id": TEXT,
        "amount": AMOUNT,
        "currency": TEXT,
        "type": TEXT,
        "status": TEXT,
        "description": TEXT,
        "ip_address": TEXT,
        "device_id": TEXT,
        "created_at": STAMP,
        "updated_at": STAMP,
    },
    required=("id", "account_id", "amount", "currency", "type", "status", "created_at", "updated_at"),
    domains={"type": TXN_TYPES, "status": TXN_STATUSES},
    defaults={"currency": "VND", "status": "pending"},
)

FRAUD_ALERTS = TableSpec(
    name="fraud_alerts",
    columns={
        "id": TEXT,
        "account_id": TEXT,
        "rule_code": TEXT,
        "severity": TEXT,
        "txn_count": WHOLE,
        "total_amount": AMOUNT,
        "evidence": TEXT,
        "status": TEXT,
        "notes": TEXT,
        "created_at": STAMP,
        "resolved_at": STAMP_OR_NULL,
    },
    required=(
        "id",
        "account_id",
        "rule_code",
        "severity",
        "txn_count",
        "total_amount",
        "evidence",
        "status",
        "created_at",
    ),
    domains={"rule_code": RULE_CODES, "severity": SEVERITIES, "status": CASE_STATUSES},
    defaults={"txn_count": "0", "total_amount": "0", "evidence": "{}", "status": "open"},
)

TABLES = {t.name: t for t in (ACCOUNTS, MERCHANTS, TRANSACTIONS, FRAUD_ALERTS)}

# One record of a message topic, as the Kafka source delivers it.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

"""Checking submitted transaction intents before the ledger sees them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.skew import salted_join
from ledgerline.functions.values import is_uuid
from ledgerline.schemas import CURRENCIES, TXN_TYPES

# ---- fixed values: defaults of a submitted intent, refusal texts ----
INTENT_DEFAULTS = {"currency": "VND", "type": "purchase", "description": "Demo from UI"}
INTENT_TYPE_ORDER = ("purchase", "transfer", "withdrawal", "deposit", "refund")
BAD_ACCOUNT = "account_id must be a UUID"
BAD_AMOUNT = "amount must be > 0"
BAD_CURRENCY = f"currency must be one of {','.join(CURRENCIES)}"
BAD_TYPE = f"type must be one of {','.join(INTENT_TYPE_ORDER)}"
NO_MERCHANT = "merchant_id or merchant (name) is required"
BAD_MERCHANT = "merchant_id must be a UUID"
UNKNOWN_MERCHANT = "merchant not found: "
# ---------------------------------------------------------------------


def validate_intents(intents: DataFrame) -> DataFrame:
    """Adds `reason`: why an intent is refused, NULL when it is acceptable.

    Columns are text as submitted; the first broken rule is named.
    """
    amount = F.col("amount").try_cast("double")
    filled = intents.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in INTENT_DEFAULTS.items() if c in intents.columns})

    def empty(name: str):
        return F.coalesce(F.col(name), F.lit("")) == ""

    bad_amount = amount.isNull() | F.isnan(amount) | (F.abs(amount) == float("inf")) | (amount <= 0)
    reason = (
        F.when(~F.coalesce(is_uuid("account_id"), F.lit(False)), BAD_ACCOUNT)
        .when(bad_amount, BAD_AMOUNT)
        .when(~F.col("currency").isin(*CURRENCIES), BAD_CURRENCY)
        .when(~F.col("type").isin(*TXN_TYPES), BAD_TYPE)
        .when(empty("merchant_id") & empty("merchant"), NO_MERCHANT)
        .when(~empty("merchant_id") & ~is_uuid("merchant_id"), BAD_MERCHANT)
    )
    return filled.withColumn("reason", reason)


def resolve_merchant(intents: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fill `merchant_id` by name where it is missing; an unknown name sets `reason`.

    Intents that bring an id skip the lookup, so only the others are exchanged;
    a name used by very many of them is spread.
    """
    has_id = F.coalesce(F.col("merchant_id"), F.lit("")) != ""
    by_name = merchants.groupBy(F.col("name").alias("merchant")).agg(F.min("id").alias("found_id"))
    given = intents.where(has_id)
    named = salted_join(intents.where(~has_id), by_name, "merchant", tie="id", how="left")
    unknown = F.concat(F.lit(UNKNOWN_MERCHANT), F.coalesce("merchant", F.lit("")))
    resolved = named.withColumns(
        {
            "merchant_id": F.col("found_id"),
            "reason": F.coalesce(F.col("reason"), F.when(F.col("found_id").isNull(), unknown)),
        }
    ).drop("found_id")
    return given.unionByName(resolved)

"""The transaction contract: schema, closed domains, fee rules and thresholds.

Everything the operators need to know about the data is stated here as plain
values, so a different ledger can be processed by passing different values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The column names, order and types of a transaction record.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

# The closed domain of ``type`` (case-sensitive).
TRANSACTION_TYPES = ("PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT")


@dataclass(frozen=True)
class FeeRule:
    """The largest fee a type may charge, as a share of the amount."""

    type: str
    rate: float
    label: str


# Fee tolerance and label per type; other types have no rule.
FEE_RULES = (
    FeeRule("PAYMENT", 0.01, "payment_fee_exceeded"),
    FeeRule("TRANSFER", 0.02, "transfer_fee_exceeded"),
    FeeRule("CASH_OUT", 0.03, "cashout_fee_exceeded"),
)
VALID_LABEL = "valid"

# The columns whose missing cells become 0 when cleaning.
FILLED_COLUMNS = ("amount", "oldbalanceOrg", "newbalanceOrig")

# An amount strictly above this is "large"; the absolute
# tolerance of the balance-arithmetic check.
LARGE_AMOUNT = 10_000
BALANCE_TOLERANCE = 0.01

# The size of a quantile sketch; about 0.13 % of error in rank.
SKETCH_ACCURACY = 4_096

# The columns that cleaning, checking and the metrics read.
REQUIRED_COLUMNS = ("type", *FILLED_COLUMNS)


@dataclass(frozen=True)
class Ledger:
    """What the layered job assumes about its input; the defaults state this contract."""

    schema: T.StructType = TRANSACTION_SCHEMA
    types: tuple[str, ...] = TRANSACTION_TYPES
    fee_rules: tuple[FeeRule, ...] = FEE_RULES
    large_amount: float = LARGE_AMOUNT
    accuracy: int = SKETCH_ACCURACY


# The columns of the metrics table, in order.
METRIC_COLUMNS = (
    "type",
    "transaction_count",
    "avg_amount_k",
    "total_volume_m",
    "median_amount_k",
    "avg_balance_change_pct",
    "zero_balance_count",
    "volume_to_balance_ratio",
    "large_txn_ratio_pct",
    "percentage_of_total",
)

"""Fixed table schemas, each defined once.

File reads bind columns by name and cast to these types, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()

# Labelled transfers: the 21 columns of the label step's result.
LABELLED = T.StructType(
    [
        T.StructField("amount", _D),
        T.StructField("amount_usd", _D),
        T.StructField("block_date", _S),
        T.StructField("block_time", _S),
        T.StructField("blockchain", _S),
        T.StructField("event_name", _S),
        T.StructField("protocol", _S),
        T.StructField("receiver", _S),
        T.StructField("receiver_contract_name", _S),
        T.StructField("receiver_ens", _S),
        T.StructField("receiver_label_categories", _S),
        T.StructField("receiver_label_models", _S),
        T.StructField("receiver_label_names", _S),
        T.StructField("receiver_name", _S),
        T.StructField("receiver_type", _S),
        T.StructField("safe_sender", _S),
        T.StructField("symbol", _S),
        T.StructField("token_address", _S),
        T.StructField("token_category", _S),
        T.StructField("tx_hash", _S),
        T.StructField("vertical", _S),
    ]
)

# Columns that a landed file may lack; they are then NULL.
OPTIONAL = (
    "receiver_contract_name",
    "receiver_ens",
    "receiver_label_categories",
    "receiver_label_models",
    "receiver_label_names",
    "receiver_name",
)

# Bronze day files hold the labelled columns without block_date, which is
# part of the directory name.
BRONZE = T.StructType([f for f in LABELLED.fields if f.name != "block_date"])

SILVER = T.StructType(
    [
        T.StructField("token_category", _S),
        T.StructField("event_name", _S),
        T.StructField("tx_hash", _S),
        T.StructField("vertical", _S),
        T.StructField("protocol", _S),
        T.StructField("amount_usd", _D),
        T.StructField("block_date", T.DateType()),
        T.StructField("week_of_year", T.IntegerType()),
        T.StructField("week_of_month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

MONEY = T.DecimalType(15, 2)

WEEK_KEYS = ("week_of_month", "week_of_year")
PARTITION_KEYS = ("year", "month")


def gold_schema(dimension: str) -> T.StructType:
    """Gold table for one dimension column (``vertical`` or ``protocol``)."""
    return T.StructType(
        [
            T.StructField("week_of_month", T.IntegerType()),
            T.StructField("week_of_year", T.IntegerType()),
            T.StructField(dimension, _S),
            T.StructField("unique_safes", T.LongType()),
            T.StructField("safe_account", _S),
            T.StructField("total_transactions_per_safe", T.LongType()),
            T.StructField("total_amount_usd_per_safe", MONEY),
            T.StructField("year", T.IntegerType()),
            T.StructField("month", T.IntegerType()),
        ]
    )


def conform(df: DataFrame, schema: T.StructType, *, strict: bool = False) -> DataFrame:
    """Select the schema's columns by name and cast them to its types.

    Columns missing from ``df`` become typed NULLs; with ``strict`` only the
    ``OPTIONAL`` ones may be missing. Extra columns are dropped. Casts use ``try_cast`` so a malformed value turns
    into NULL instead of failing the whole job.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        elif strict and f.name not in OPTIONAL:
            raise ValueError(f"column {f.name!r} is missing; have {sorted(have)}")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)

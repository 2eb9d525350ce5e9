"""Table sources: label tables by name, and small literal tables.

Literal rows are built JVM-side with ``inline(array(struct(...)))`` so they
plan as a local table scan, with no Python worker per task and no RDD.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL_TABLE_ROLES = (
    "transfers",
    "wallets",
    "ens",
    "contracts",
    "addresses",
    "logs",
    "burn",
    "creation",
    "stablecoins",
    "stakers",
)


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A small DataFrame of literal ``rows`` with the given ``schema``."""
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def number_range(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    """Integers ``0 .. n-1`` as one int column (distributed, no driver data)."""
    return spark.range(n).select(F.col("id").cast("int").alias(name))


def label_tables(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the label step's input tables; ``paths`` maps role to location.

    Roles: transfers, wallets, ens, contracts, addresses, logs, burn,
    creation, stablecoins, stakers. A location that names a catalog table
    (no ``/``) is read with ``spark.table``.
    """
    missing = [r for r in LABEL_TABLE_ROLES if r not in paths]
    if missing:
        raise KeyError(f"missing label tables: {missing}")
    out = {}
    for role in LABEL_TABLE_ROLES:
        loc = paths[role]
        out[role] = spark.table(loc) if "/" not in loc else spark.read.format(fmt).load(loc)
    return out

"""Mapping of the supplied test tables onto the pipeline's inputs.

The supplied parquet tables (TPC-H-like, plus ``events``) stand in for the
transfer and label tables. Every frame here is derived from those tables by
Spark, so its size grows with the scale factor. The oracle SQL in
``chainfold.plans.oracle`` builds the same frames in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.sources.tables import literal_table

# Fixed values of the fixture mapping (test data only, not library logic).
# Blockchains each label row is repeated for:
BLOCKCHAINS = ("F", "O", "P")
# Contract label names for supplier slots 0 to 14, in slot order:
CONTRACT_NAMES = (
    "Gnosis_safe: GnosisSafeProxy",
    "Myname: WETH9",
    "Stargate: Router",
    "Curvefi: Pool",
    "Uniswap_v2: Router",
    "Aave_v3: Pool",
    "Lido: stETH",
    "Eigenlayer: StrategyManager",
    "Renzo: Deposit",
    "Pendle: Router",
    "Maker: Vat",
    "Dydx: Perp",
    "Anzen_finance_v2: Vault",
    "Zircuit_staking: Pool",
    "Llamapay: Stream",
)
# Address labels: (slot, name, category, model_name, label_type).
ADDRESS_LABELS = (
    (15, "Null burn", "burn", "burn_addresses", "identifier"),
    (16, "Exch hot", "institution", "cex_ethereum", "identifier"),
    (17, "Brdg", "bridge", "bridges", "identifier"),
    (18, "soc", "social", "ens", "identifier"),
    (19, "Some DAO: main", "dao", "dao_multisig", "identifier"),
    (3, "whale", "x", "whale", "persona"),
    (4, "mevbot", "x", "mev", "usage"),
    (5, "val", "x", "validators_ethereum", "identifier"),
)
SLOTS = 20
STAKER_SLOT = 18
WALLET_SEGMENT = "BUILDING"
STABLECOIN_TYPE = "PROMO"
REPLAY_EVERY = 10

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


# Schemas of the supplied tables the mapping reads; reading with a given
# schema skips the footer-reading job that schema inference would run.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- events side


def event_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as silver input (tx_hash, event_name, vertical, protocol,
    amount_usd, token_category, block_date), with every tenth event replayed
    once so that exact duplicates exist."""
    ev = table(spark, sf_dir, "events")
    replay = ev.where(F.col("event_id") % REPLAY_EVERY == 0)
    rows = ev.unionByName(replay)
    # json_tuple plans as a generator, which filters are not pushed below,
    # so the JSON text is parsed once per row rather than once per use of k.
    rows = rows.select("*", F.json_tuple("props", "k").alias("k_text")).withColumn(
        "k", F.col("k_text").try_cast("int")
    )
    return rows.select(
        F.col("user_id").cast("string").alias("tx_hash"),
        F.when(F.col("event_type") == "error", F.lit("Approval")).otherwise(F.lit("Transfer")).alias("event_name"),
        F.col("event_type").alias("vertical"),
        F.when(F.col("k") % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("p"), (F.col("k") % 7).cast("string")))
        .alias("protocol"),
        F.when(F.col("k") % 17 == 0, F.lit(None).cast("double"))
        .when(F.col("k") % 13 == 0, -F.col("value"))
        .otherwise(F.col("value"))
        .alias("amount_usd"),
        F.when(F.col("k") % 5 == 0, F.lit("stablecoin")).otherwise(F.lit("erc20")).alias("token_category"),
        F.to_date("ts").alias("block_date"),
    )


# ----------------------------------------------------------------- label side


def label_transfers_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` joined to ``orders`` and ``part`` as raw transfers."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)
    return j.select(
        F.col("o_orderstatus").alias("blockchain"),
        F.to_date("l_shipdate").alias("block_date"),
        F.col("l_shipdate").alias("block_time"),
        F.col("l_orderkey").alias("tx_hash"),
        F.col("l_linenumber").alias("evt_index"),
        F.col("o_custkey").alias("from"),
        F.col("l_suppkey").alias("to"),
        F.col("l_partkey").alias("contract_address"),
        F.col("p_type").alias("token_standard"),
        F.col("p_brand").alias("symbol"),
        F.col("l_quantity").alias("amount"),
        F.col("l_extendedprice").alias("amount_usd"),
    )


def _per_chain(df: DataFrame) -> DataFrame:
    return df.withColumn("blockchain", F.explode(F.array(*[F.lit(b) for b in BLOCKCHAINS])))


def label_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ten input tables of the label step, keyed by role."""
    cust = table(spark, sf_dir, "customer")
    sup = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    slot = (F.col("s_suppkey") % SLOTS).cast("int")

    wallets = cust.where(F.col("c_mktsegment") == WALLET_SEGMENT).select(F.col("c_custkey").alias("address"))
    burn = sup.where(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("address"))
    creation = sup.where(F.col("s_nationkey") % 2 == 0).select(F.col("s_suppkey").alias("address"))
    stakers = sup.where(slot == STAKER_SLOT).select(F.col("s_suppkey").alias("address"))
    stablecoins = _per_chain(
        part.where(F.col("p_type") == STABLECOIN_TYPE).select(F.col("p_partkey").alias("stablecoin_address"))
    ).select("blockchain", "stablecoin_address")
    ens = sup.where(F.col("s_suppkey") % 3 == 0).select(
        F.col("s_suppkey").alias("address"), F.concat(F.lower("s_name"), F.lit(".eth")).alias("name")
    )
    contracts = _per_chain(
        sup.where(slot < len(CONTRACT_NAMES)).select(
            F.col("s_suppkey").alias("address"),
            F.element_at(F.array(*[F.lit(n) for n in CONTRACT_NAMES]), slot + 1).alias("name"),
        )
    ).select("address", "blockchain", "name")
    label_rows = literal_table(
        spark,
        ADDRESS_LABELS,
        T.StructType(
            [
                T.StructField("slot", T.IntegerType()),
                T.StructField("name", T.StringType()),
                T.StructField("category", T.StringType()),
                T.StructField("model_name", T.StringType()),
                T.StructField("label_type", T.StringType()),
            ]
        ),
    )
    addresses = _per_chain(
        sup.select(F.col("s_suppkey").alias("address"), slot.alias("slot")).join(F.broadcast(label_rows), "slot")
    ).select("address", "blockchain", "name", "category", "model_name", "label_type")
    logs = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tx_hash"),
        F.col("l_linenumber").alias("index"),
        F.col("l_returnflag").alias("event_name"),
        F.to_date("l_shipdate").alias("block_date"),
    )
    return {
        "transfers": label_transfers_input(spark, sf_dir),
        "wallets": wallets,
        "ens": ens,
        "contracts": contracts,
        "addresses": addresses,
        "logs": logs,
        "burn": burn,
        "creation": creation,
        "stablecoins": stablecoins,
        "stakers": stakers,
    }

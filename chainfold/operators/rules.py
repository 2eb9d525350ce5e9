"""Classification rules of the label step: fixed values, receiver type, name, protocol.

Only column expressions; they compile into the generated code of the
surrounding stage. Verticals come from a table of rules (``name_rules``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainfold.functions.text import concat_strict, first_non_null, first_part

# ----------------------------------------------------------------------------
# Fixed values. These must equal the original rules for equal results.
#
# Receiver types, in the order they are tested:
SAFE = "Safe"
BURNER = "Burner address"
SMART_CONTRACT = "Smart contract"
EOA = "EOA"
# Prefix of the fallback vertical and protocol:
UNCLASSIFIED = "unclassified transfer to "
# Contract names matching this pattern are shown as "Safe":
SAFE_CONTRACT_PATTERN = "%Gnosis_safe%"
# Address-label filters applied before labels are used:
EXCLUDED_CATEGORIES = ("contracts", "social")
EXCLUDED_MODELS = ("validators_ethereum",)
EXCLUDED_LABEL_TYPES = ("persona", "usage")
KEPT_MODELS_DESPITE_TYPE = ("dex_pools", "dao_framework", "mev", "flashbots")
# Label model of DAO multisigs, whose name comes from the label:
DAO_MODEL = "dao_multisig"
DAO_NAME_PREFIX = "Safe: "
# Verticals decided by a label, a contract name or staking:
BURN_MODEL, BURN_VERTICAL = "burn_addresses", "burn address"
WRAPPER_CONTRACT, WRAPPER_VERTICAL = "Myname: WETH9", "eth wrapping"
CEX_MODEL, CEX_VERTICAL = "cex_ethereum", "CEX"
BRIDGE_CATEGORY, DEX_CATEGORY = "bridge", "dex"
SWAP_PATTERN = "%swap%"
STAKING_VERTICAL = "ETH staking"
# Vertical name lists in rule order (first match wins):
VERTICAL_NAMES = (
    ("bridge", ("Across_v2", "Hop_protocol", "Stargate", "Stargate_v2", "Zklink")),
    ("DEX", ("Balancer_v2", "Curvefi", "Curve", "Gnosis_protocol_v2", "Lifi", "Oneinch", "Sushi")),
    (
        "lending",
        (
            "Aave",
            "Aave_v2",
            "Aave_v3",
            "Clearpool_finance",
            "Clearpool",
            "Compound_v2",
            "Compound_v3",
            "Curve_lend",
            "Echelon",
            "Euler",
            "Fluid",
            "Fluxfinance",
            "Fraxfinance",
            "Maplefinance_v2",
            "Midas",
            "Morpho",
            "Morpho_blue",
            "Morpho_aave_v2",
            "Morpho_compound",
            "Silo",
            "Spark_protocol",
            "Uwulend",
            "Yearn",
        ),
    ),
    (
        "liquid staking",
        (
            "Etherfi",
            "Etherfiliquiditypool",
            "Frax",
            "Lido",
            "Mantle",
            "Meveth",
            "Pirex",
            "Rocketpool",
            "Rockx_liquid_staking",
            "Stader",
            "Stakewise",
            "Stakewise_v3",
            "Swell_v3",
        ),
    ),
    ("restaking", ("Eigenlayer", "Symbiotic")),
    ("liquid restaking", ("Kelpdao", "Mellow_lrt", "Renzo")),
    (
        "yield",
        (
            "Aura_finance",
            "Apecoin",
            "Convex",
            "Ethena_labs",
            "Eth_fox_vault",
            "Instadapp_lite",
            "Origin_protocol",
            "Pendle",
            "Redacted",
            "Tokemak",
            "Usual",
        ),
    ),
    ("CDP", ("Abracadabra", "Amp", "Lybra_finance", "Maker", "Threshold_network")),
    ("derivatives", ("Contango_v2", "Dydx")),
    ("rwa", ("Anzen_finance_v2",)),
    ("farm", ("Zircuit_staking",)),
    ("payments", ("Llamapay",)),
)
# ----------------------------------------------------------------------------

def label_kept() -> Column:
    """Address labels that may be used (applied to the label table)."""
    cat, model, ltype = F.col("category"), F.col("model_name"), F.col("label_type")
    return (
        ~cat.isin(*EXCLUDED_CATEGORIES)
        & ~model.isin(*EXCLUDED_MODELS)
        & (~ltype.isin(*EXCLUDED_LABEL_TYPES) | model.isin(*KEPT_MODELS_DESPITE_TYPE))
    )


def receiver_type(is_safe: Column, is_burn: Column, is_contract: Column) -> Column:
    return (
        F.when(is_safe, F.lit(SAFE))
        .when(is_burn, F.lit(BURNER))
        .when(is_contract, F.lit(SMART_CONTRACT))
        .otherwise(F.lit(EOA))
    )


def display_contract_name(contract_name: Column) -> Column:
    return F.when(contract_name.like(SAFE_CONTRACT_PATTERN), F.lit(SAFE)).otherwise(contract_name)


def receiver_name(label_models: Column, label_names: Column, contract_name: Column, ens: Column) -> Column:
    """DAO multisigs are named from their label; otherwise the contract's
    project (text before ``": "``), else the label, else the ENS name."""
    return F.when(
        label_models == F.lit(DAO_MODEL),
        concat_strict(DAO_NAME_PREFIX, first_part(label_names, ":")),
    ).otherwise(first_non_null(first_part(contract_name, ": "), label_names, ens))


def unclassified(rtype: Column) -> Column:
    return F.concat(F.lit(UNCLASSIFIED), rtype)


def protocol(contract_name: Column, rtype: Column) -> Column:
    return F.coalesce(contract_name, unclassified(rtype))


def token_category(is_stablecoin: Column, token_standard: Column) -> Column:
    return F.when(is_stablecoin, F.lit("stablecoin")).otherwise(token_standard)

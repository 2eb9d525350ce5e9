"""Label step: one hand-made receiver per rule, fan-out cases, plan paths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chainfold.operators import labels as L
from chainfold.operators.compare import same_rows
from chainfold.plans.testdata import label_inputs
from tests.conftest import CHECK_DIR, rows

DAY = dt.date(2024, 11, 23)


def _inputs(spark, transfers, *, wallets=(), ens=(), contracts=(), addresses=(), logs=(), burn=(), creation=(), stablecoins=(), stakers=()):
    def df(data, schema):
        return spark.createDataFrame(list(data), schema)

    return {
        "transfers": df(
            transfers,
            "blockchain string, block_date date, block_time string, tx_hash string, evt_index int, `from` string, "
            "`to` string, contract_address string, token_standard string, symbol string, amount double, amount_usd double",
        ),
        "wallets": df(wallets, "address string"),
        "ens": df(ens, "address string, name string"),
        "contracts": df(contracts, "address string, blockchain string, name string"),
        "addresses": df(
            addresses, "address string, blockchain string, name string, category string, model_name string, label_type string"
        ),
        "logs": df(logs, "tx_hash string, index int, event_name string"),
        "burn": df(burn, "address string"),
        "creation": df(creation, "address string"),
        "stablecoins": df(stablecoins, "blockchain string, stablecoin_address string"),
        "stakers": df(stakers, "address string"),
    }


def _t(tx, to, amount=10.0, chain="ethereum", sender="s1", token="tok"):
    return (chain, DAY, "2024-11-23 00:00:00", tx, 0, sender, to, token, "erc20", "SYM", 1.0, amount)


CASES = {
    # receiver: (label rows, contract name, flags, expected vertical, expected protocol)
    "r_burn": "burn address",
    "r_weth": "eth wrapping",
    "r_cex": "CEX",
    "r_bridge_cat": "bridge",
    "r_bridge_name": "bridge",
    "r_dex_name": "DEX",
    "r_swap": "DEX",
    "r_swap_eoa": "unclassified transfer to EOA",
    "r_lend": "lending",
    "r_lst": "liquid staking",
    "r_restake": "restaking",
    "r_lrt": "liquid restaking",
    "r_staker": "ETH staking",
    "r_yield": "yield",
    "r_cdp": "CDP",
    "r_deriv": "derivatives",
    "r_rwa": "rwa",
    "r_farm": "farm",
    "r_pay": "payments",
    "r_safe": "unclassified transfer to Safe",
    "r_burner": "unclassified transfer to Burner address",
    "r_contract": "unclassified transfer to Smart contract",
    "r_eoa": "unclassified transfer to EOA",
    "r_dao": "unclassified transfer to EOA",
    "r_social": "unclassified transfer to EOA",
}


def _rule_inputs(spark):
    c = "ethereum"
    transfers = [_t(f"tx_{r}", r) for r in CASES] + [
        _t("tx_small", "r_eoa", amount=0.0),  # not positive: dropped
        ("ethereum", DAY, "x", "tx_other", 0, "not_a_wallet", "r_eoa", "tok", "erc20", "S", 1.0, 5.0),
    ]
    contracts = [
        ("r_weth", c, "Myname: WETH9"),
        ("r_bridge_name", c, "Stargate: Router"),
        ("r_dex_name", c, "Curvefi: Pool"),
        ("r_swap", c, "Uniswap_v2: Router"),
        ("r_swap_eoa", c, "Uniswap_v2: Router"),
        ("r_lend", c, "Aave_v3: Pool"),
        ("r_lst", c, "Lido: stETH"),
        ("r_restake", c, "Eigenlayer: StrategyManager"),
        ("r_lrt", c, "Renzo: Deposit"),
        ("r_yield", c, "Pendle: Router"),
        ("r_cdp", c, "Maker: Vat"),
        ("r_deriv", c, "Dydx: Perp"),
        ("r_rwa", c, "Anzen_finance_v2: Vault"),
        ("r_farm", c, "Zircuit_staking: Pool"),
        ("r_pay", c, "Llamapay: Stream"),
        ("r_safe", c, "Gnosis_safe: GnosisSafeProxy"),
        ("r_dao", c, "Gnosis_safe: GnosisSafeProxy"),
    ]
    addresses = [
        ("r_burn", c, "Null", "burn", "burn_addresses", "identifier"),
        ("r_cex", c, "Exch", "institution", "cex_ethereum", "identifier"),
        ("r_bridge_cat", c, "Brdg", "bridge", "bridges", "identifier"),
        ("r_dao", c, "Some DAO: main", "dao", "dao_multisig", "identifier"),
        ("r_social", c, "soc", "social", "ens", "identifier"),
        ("r_eoa", c, "whale", "x", "whale", "persona"),
    ]
    return _inputs(
        spark,
        transfers,
        wallets=[("s1",), ("r_safe",)],
        contracts=contracts,
        addresses=addresses,
        ens=[("r_eoa", "someone.eth"), ("r_social", "soc.eth")],
        burn=[("r_burner",)],
        creation=[("r_swap",), ("r_staker",), ("r_contract",), ("r_burner",)],
        stakers=[("r_staker",), ("r_eoa",)],
        stablecoins=[(c, "tok")],
        logs=[("tx_r_eoa", 0, "Transfer")],
    )


def test_every_rule(spark):
    out = L.label_transfers(_rule_inputs(spark), materialize_steps=False)
    got = {r.receiver: r for r in out.collect()}
    assert set(got) == set(CASES)
    for recv, vertical in CASES.items():
        assert got[recv].vertical == vertical, recv
    assert got["r_safe"].receiver_type == "Safe" and got["r_safe"].receiver_contract_name == "Safe"
    assert got["r_safe"].receiver_name == "Gnosis_safe" and got["r_safe"].protocol == "Safe"
    assert got["r_burner"].receiver_type == "Burner address"  # burn wins over contract
    assert got["r_dao"].receiver_name == "Safe: Some DAO"
    assert got["r_eoa"].receiver_name == "someone.eth" and got["r_eoa"].receiver_label_names is None
    assert got["r_eoa"].event_name == "Transfer" and got["r_lend"].event_name is None
    assert got["r_lend"].protocol == "Aave_v3: Pool" and got["r_lend"].receiver_name == "Aave_v3"
    assert got["r_eoa"].protocol == "unclassified transfer to EOA"
    assert got["r_eoa"].token_category == "stablecoin"
    assert got["r_social"].receiver_label_categories is None and got["r_social"].receiver_ens == "soc.eth"
    assert len(out.columns) == 21


def test_fan_out_semantics(spark):
    c1, c2 = "ethereum", "gnosis"
    inp = _inputs(
        spark,
        [_t("tx1", "r", chain=c1), _t("tx2", "r", chain=c2)],
        wallets=[("s1",)],
        contracts=[("r", c1, "Aave_v3: Pool"), ("r", c2, "Lido: stETH")],
        logs=[("tx1", 0, "Transfer"), ("tx1", 0, "Approval"), ("tx1", 0, "Transfer")],
    )
    same = L.label_transfers(inp, materialize_steps=False)
    got = rows(same.select("tx_hash", "blockchain", "vertical", "event_name"))
    # Each chain its own label; two distinct event names duplicate tx1.
    assert got == [
        ("tx1", c1, "lending", "Approval"),
        ("tx1", c1, "lending", "Transfer"),
        ("tx2", c2, "liquid staking", None),
    ]
    cross = L.label_transfers(inp, same_chain=False, materialize_steps=False)
    # Address-only matching: every transfer meets both chains' labels.
    assert cross.count() == 6


def test_plan_paths_agree(spark):
    """Broadcast plans and shuffle/salted fallbacks give the same rows."""
    inp = label_inputs(spark, CHECK_DIR)
    a = L.label_transfers(inp)
    b = L.label_transfers(inp, max_broadcast_rows=0, materialize_steps=False)
    assert a.count() == 15970
    assert same_rows(a, b).count() == 0
    # Every transfer gets a receiver type, and with it a vertical and a protocol.
    missing = a.where(
        F.col("receiver_type").isNull() | F.col("vertical").isNull() | F.col("protocol").isNull()
    ).count()
    assert missing == 0


def test_receiver_types_paths_agree(spark):
    inp = label_inputs(spark, CHECK_DIR)
    t = L.wallet_transfers(inp["transfers"], inp["wallets"])
    a = L.receiver_types(t, inp).select("tx_hash", "evt_index", "to", "receiver_type")
    b = L.receiver_types(t, inp, max_broadcast_rows=0, materialize_steps=False).select(
        "tx_hash", "evt_index", "to", "receiver_type"
    )
    assert a.count() == 11930
    assert same_rows(a, b).count() == 0


def test_ordered_result(spark):
    inputs = label_inputs(spark, CHECK_DIR)
    dates = [r[0] for r in L.label_transfers(inputs, order_by_date=True).select("block_date").collect()]
    assert len(set(dates)) > 10 and dates == sorted(dates)

"""DuckDB SQL building blocks for the oracle side.

Each block is a list of CTEs written independently of the Spark code, over
views named after the supplied tables. ``with_(...)`` joins blocks into a
``WITH`` clause. DuckDB differs from Spark in a few places, handled here:
``dayofweek`` has Sunday = 0, ``CAST(double AS INT)`` rounds (so ``trunc``
first), sums of decimals and bigints widen (so cast back), and ``concat``
skips NULLs (so ``||`` is used).
"""

from __future__ import annotations


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip().rstrip(",") for b in blocks)


# 4.1: events as transfers, every tenth event replayed once.
EVENTS = """
ev_src AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0),
ev_k AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM ev_src),
transfers_ev AS (
  SELECT CAST(user_id AS VARCHAR) AS tx_hash,
         CASE WHEN event_type = 'error' THEN 'Approval' ELSE 'Transfer' END AS event_name,
         event_type AS vertical,
         CASE WHEN k % 11 = 0 THEN NULL ELSE 'p' || CAST(k % 7 AS VARCHAR) END AS protocol,
         CASE WHEN k % 17 = 0 THEN NULL WHEN k % 13 = 0 THEN -value ELSE value END AS amount_usd,
         CASE WHEN k % 5 = 0 THEN 'stablecoin' ELSE 'erc20' END AS token_category,
         CAST(ts AS DATE) AS block_date
  FROM ev_k)
"""


def week_of_month_sql(d: str, start: str = "sunday") -> str:
    first = f"CAST(date_trunc('month', {d}) AS DATE)"
    offset = f"dayofweek({first})" if start == "sunday" else f"(isodow({first}) - 1)"
    return f"CAST(floor((dayofmonth({d}) - 1 + {offset}) / 7) + 1 AS INTEGER)"


CALENDAR_COLS = f"""
CAST(weekofyear(block_date) AS INTEGER) AS week_of_year,
{week_of_month_sql('block_date')} AS week_of_month,
CAST(year(block_date) AS INTEGER) AS year,
CAST(month(block_date) AS INTEGER) AS month"""

# A concatenation is NULL if one of its parts is.
CLEAN = "event_name = '{event}' AND amount_usd > 0 AND (tx_hash || vertical || protocol) IS NOT NULL"

SILVER = f"""
silver AS (
  SELECT token_category, event_name, tx_hash, vertical, protocol, amount_usd, block_date,
  {CALENDAR_COLS}
  FROM (SELECT DISTINCT token_category, event_name, tx_hash, vertical, protocol, amount_usd, block_date
        FROM transfers_ev WHERE {CLEAN.format(event='Transfer')}))
"""


def gold(dim: str, src: str = "silver") -> str:
    keys = f"year, month, week_of_month, week_of_year, {dim}"
    on = " AND ".join(f"p.{k} = t.{k}" for k in ("year", "month", "week_of_month", "week_of_year", dim))
    return f"""
pe_{dim} AS (
  SELECT {keys}, tx_hash AS safe_account,
         COUNT(tx_hash) AS total_transactions_per_safe,
         CAST(SUM(CAST(amount_usd AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS total_amount_usd_per_safe
  FROM {src} GROUP BY {keys}, tx_hash),
tot_{dim} AS (SELECT {keys}, COUNT(safe_account) AS unique_safes FROM pe_{dim} GROUP BY {keys}),
gold_{dim} AS (
  SELECT p.week_of_month, p.week_of_year, p.{dim}, t.unique_safes, p.safe_account,
         p.total_transactions_per_safe, p.total_amount_usd_per_safe, p.year, p.month
  FROM pe_{dim} p JOIN tot_{dim} t ON {on})
"""


def topk(dim: str, measure: str, k: int = 5, src: str | None = None) -> str:
    src = src or f"gold_{dim}"
    if measure == "count":
        agg = "CAST(SUM(total_transactions_per_safe) AS BIGINT) AS highest_transaction_count"
    else:
        agg = "CAST(SUM(total_amount_usd_per_safe) AS DECIMAL(25,2)) AS highest_transaction_volume"
    return f"SELECT {dim}, {agg} FROM {src} GROUP BY {dim} ORDER BY 2 DESC NULLS LAST, 1 ASC NULLS LAST LIMIT {k}"


# 4.2: lineitem and its dimensions as transfers and label tables.
def _label_inputs() -> str:
    from chainfold.plans.testdata import ADDRESS_LABELS, BLOCKCHAINS, CONTRACT_NAMES

    chains = "unnest([" + ", ".join(f"'{b}'" for b in BLOCKCHAINS) + "])"
    names = ", ".join(f"'{n}'" for n in CONTRACT_NAMES)
    slots = ", ".join(f"({s}, '{n}', '{c}', '{m}', '{t}')" for s, n, c, m, t in ADDRESS_LABELS)
    return f"""
tr AS (
  SELECT o.o_orderstatus AS blockchain, CAST(l.l_shipdate AS DATE) AS block_date, l.l_shipdate AS block_time,
         l.l_orderkey AS tx_hash, l.l_linenumber AS evt_index, o.o_custkey AS "from", l.l_suppkey AS "to",
         l.l_partkey AS contract_address, p.p_type AS token_standard, p.p_brand AS symbol,
         l.l_quantity AS amount, l.l_extendedprice AS amount_usd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),
wallets AS (SELECT c_custkey AS address FROM customer WHERE c_mktsegment = 'BUILDING'),
burn_list AS (SELECT s_suppkey AS address FROM supplier WHERE s_acctbal < 0),
created AS (SELECT s_suppkey AS address FROM supplier WHERE s_nationkey % 2 = 0),
stakers AS (SELECT s_suppkey AS address FROM supplier WHERE s_suppkey % 20 = 18),
stablecoins AS (SELECT {chains} AS blockchain, p_partkey AS stablecoin_address FROM part WHERE p_type = 'PROMO'),
ens AS (SELECT s_suppkey AS address, lower(s_name) || '.eth' AS name FROM supplier WHERE s_suppkey % 3 = 0),
contracts AS (
  SELECT s_suppkey AS address, {chains} AS blockchain,
         list_extract([{names}], CAST(s_suppkey % 20 AS INTEGER) + 1) AS name
  FROM supplier WHERE s_suppkey % 20 < {len(CONTRACT_NAMES)}),
label_slots AS (SELECT * FROM (VALUES {slots}) v(slot, name, category, model_name, label_type)),
addresses AS (
  SELECT s.s_suppkey AS address, {chains} AS blockchain, a.name, a.category, a.model_name, a.label_type
  FROM supplier s JOIN label_slots a ON s.s_suppkey % 20 = a.slot),
logs AS (SELECT l_orderkey AS tx_hash, l_linenumber AS "index", l_returnflag AS event_name FROM lineitem)
"""


LABEL_INPUTS = _label_inputs()

SAFE_TRANSFERS = """
wallet_tx AS (SELECT * FROM tr WHERE amount_usd > 0 AND "from" IN (SELECT address FROM wallets))
"""

# What is known of each receiver, as (fact, value) rows; a receiver's fact is its least value.
USABLE_LABELS = """
usable AS (
  SELECT * FROM addresses
  WHERE NOT list_contains(['contracts', 'social'], category)
    AND NOT list_contains(['validators_ethereum'], model_name)
    AND CASE WHEN list_contains(['persona', 'usage'], label_type)
        THEN list_contains(['dao_framework', 'dex_pools', 'flashbots', 'mev'], model_name) ELSE true END)"""

RECEIVER_FACTS = USABLE_LABELS + """,
facts AS (
  SELECT blockchain, address, unnest(['label', 'category', 'model']) AS fact, unnest([name, category, model_name]) AS value FROM usable
  UNION ALL SELECT blockchain, address, 'contract', name FROM contracts),
recv_info AS (
  SELECT k.blockchain, k."to" AS address,
    (SELECT min(value) FROM facts f WHERE fact = 'label' AND f.address = k."to" AND f.blockchain = k.blockchain) AS label_names,
    (SELECT min(value) FROM facts f WHERE fact = 'category' AND f.address = k."to" AND f.blockchain = k.blockchain) AS label_categories,
    (SELECT min(value) FROM facts f WHERE fact = 'model' AND f.address = k."to" AND f.blockchain = k.blockchain) AS label_models,
    (SELECT min(value) FROM facts f WHERE fact = 'contract' AND f.address = k."to" AND f.blockchain = k.blockchain) AS contract_name,
    (SELECT min(name) FROM ens WHERE ens.address = k."to") AS ens
  FROM (SELECT blockchain, "to" FROM wallet_tx WHERE "to" IS NOT NULL GROUP BY ALL) k),
tx_events AS (SELECT tx_hash, "index", event_name FROM logs SEMI JOIN wallet_tx USING (tx_hash) GROUP BY ALL),
kinds AS (
  SELECT address, arg_min(kind, place) AS kind
  FROM (SELECT address, 1 AS place, 'Safe' AS kind FROM wallets
        UNION ALL SELECT address, 2, 'Burner address' FROM burn_list
        UNION ALL SELECT address, 3, 'Smart contract' FROM created)
  GROUP BY address)
"""

# Place of each vertical among the rules, and the receiver names that belong to it.
PLACES = {
    "burn address": 1, "eth wrapping": 2, "CEX": 3, "bridge": 4, "DEX": 5, "lending": 6, "liquid staking": 7, "restaking": 8,
    "liquid restaking": 9, "ETH staking": 10, "yield": 11, "CDP": 12, "derivatives": 13, "rwa": 14, "farm": 15, "payments": 16,
}
NAMES = {
    "bridge": "Across_v2 Hop_protocol Stargate Stargate_v2 Zklink",
    "DEX": "Balancer_v2 Curvefi Curve Gnosis_protocol_v2 Lifi Oneinch Sushi",
    "lending": "Aave Aave_v2 Aave_v3 Clearpool_finance Clearpool Compound_v2 Compound_v3 Curve_lend Echelon Euler Fluid Fluxfinance "
    "Fraxfinance Maplefinance_v2 Midas Morpho Morpho_blue Morpho_aave_v2 Morpho_compound Silo Spark_protocol Uwulend Yearn",
    "liquid staking": "Etherfi Etherfiliquiditypool Frax Lido Mantle Meveth Pirex Rocketpool Rockx_liquid_staking Stader Stakewise "
    "Stakewise_v3 Swell_v3",
    "restaking": "Eigenlayer Symbiotic",
    "liquid restaking": "Kelpdao Mellow_lrt Renzo",
    "yield": "Aura_finance Apecoin Convex Ethena_labs Eth_fox_vault Instadapp_lite Origin_protocol Pendle Redacted Tokemak Usual",
    "CDP": "Abracadabra Amp Lybra_finance Maker Threshold_network",
    "derivatives": "Contango_v2 Dydx",
    "rwa": "Anzen_finance_v2",
    "farm": "Zircuit_staking",
    "payments": "Llamapay",
}


def _name_rules() -> str:
    return ", ".join(f"({PLACES[v]}, '{v}', '{n}')" for v, names in NAMES.items() for n in names.split())


def _hit(vertical: str, condition: str) -> str:
    return f"SELECT profile, {PLACES[vertical]} AS place, '{vertical}' AS vertical FROM lab_profiles WHERE {condition}"


_HITS = "\n  UNION ALL ".join(
    [
        "SELECT profile, place, r.vertical FROM lab_profiles JOIN name_rules r ON r.name = receiver_name",
        _hit("ETH staking", "receiver_type = 'Smart contract' AND receiver IN (FROM stakers)"),
        _hit("DEX", "receiver_label_categories = 'dex'"),
        _hit("DEX", "receiver_type = 'Smart contract' AND contains(lower(receiver_name), 'swap')"),
        _hit("bridge", "receiver_label_categories = 'bridge'"),
        _hit("CEX", "receiver_label_models = 'cex_ethereum'"),
        _hit("eth wrapping", "receiver_contract_name = 'Myname: WETH9'"),
        _hit("burn address", "receiver_label_models = 'burn_addresses'"),
    ]
)


def labelled(same_chain: bool = True) -> str:
    """The label step: verticals come from the rule of the lowest place that a receiver's profile hits.

    ``same_chain=False`` joins receiver facts on the address only, so a
    receiver seen on several chains meets every chain's facts.
    """
    chain = "AND i.blockchain IS NOT DISTINCT FROM w.blockchain" if same_chain else ""
    return f"""
lab_rows AS (
  SELECT w.*, i.label_names, i.label_categories, i.label_models, i.ens, coalesce(kinds.kind, 'EOA') AS receiver_type,
    if(i.contract_name LIKE '%Gnosis_safe%', 'Safe', i.contract_name) AS shown,
    'Safe: ' || string_split(i.label_names, ':')[1] AS dao,
    coalesce(string_split(i.contract_name, ': ')[1], i.label_names, i.ens) AS usual,
    e.event_name,
    EXISTS (FROM stablecoins c WHERE c.blockchain = w.blockchain AND c.stablecoin_address = w.contract_address) AS stable
  FROM tx_events e RIGHT JOIN wallet_tx w ON e.tx_hash = w.tx_hash AND e."index" = w.evt_index
  LEFT JOIN kinds ON kinds.address = w."to"
  LEFT JOIN recv_info i ON i.address = w."to" {chain}),
lab_base AS (
  SELECT blockchain, block_date, block_time, tx_hash, evt_index, event_name, symbol, amount, amount_usd,
    "from" AS safe_sender, "to" AS receiver, contract_address AS token_address, if(stable, 'stablecoin', token_standard) AS token_category,
    receiver_type, shown AS receiver_contract_name, label_names AS receiver_label_names, label_categories AS receiver_label_categories,
    label_models AS receiver_label_models, ens AS receiver_ens,
    CASE WHEN label_models = 'dao_multisig' THEN dao ELSE usual END AS receiver_name
  FROM lab_rows),
lab_numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY receiver, receiver_type, receiver_contract_name, receiver_label_models,
    receiver_label_categories, receiver_name) AS profile FROM lab_base),
lab_profiles AS (
  SELECT profile, receiver, receiver_type, receiver_contract_name, receiver_label_models, receiver_label_categories, receiver_name
  FROM lab_numbered GROUP BY ALL),
name_rules AS (FROM (VALUES {_name_rules()}) t(place, vertical, name)),
lab_hits AS (
  {_HITS}),
lab_verdicts AS (SELECT profile, arg_min(vertical, place) AS vertical FROM lab_hits GROUP BY profile),
lab_out AS (
  SELECT n.* EXCLUDE (profile), coalesce(v.vertical, 'unclassified transfer to ' || receiver_type) AS vertical,
    coalesce(receiver_contract_name, 'unclassified transfer to ' || receiver_type) AS protocol
  FROM lab_numbered n LEFT JOIN lab_verdicts v USING (profile))
"""


LABELLED = labelled()
LABEL_ALL = with_(LABEL_INPUTS, SAFE_TRANSFERS, RECEIVER_FACTS, LABELLED)
LABEL_ALL_ADDRESS_JOIN = with_(LABEL_INPUTS, SAFE_TRANSFERS, RECEIVER_FACTS, labelled(same_chain=False))

LABELLED_21 = """
SELECT amount, amount_usd, CAST(block_date AS VARCHAR) AS block_date,
       strftime(block_time, '%Y-%m-%d %H:%M:%S.%g UTC') AS block_time, blockchain, event_name, protocol,
       CAST(receiver AS VARCHAR) AS receiver, receiver_contract_name, receiver_ens, receiver_label_categories,
       receiver_label_models, receiver_label_names, receiver_name, receiver_type,
       CAST(safe_sender AS VARCHAR) AS safe_sender, symbol, CAST(token_address AS VARCHAR) AS token_address,
       token_category, CAST(tx_hash AS VARCHAR) AS tx_hash, vertical
FROM lab_out"""


def silver_from(src: str, event_name: str, name: str = "silver_l") -> str:
    """Quarantine over any CTE with the transfer columns."""
    where = CLEAN.format(event=event_name)
    return f"""
{name} AS (
  SELECT token_category, event_name, tx_hash, vertical, protocol, amount_usd, block_date,
  {CALENDAR_COLS}
  FROM (SELECT DISTINCT token_category, event_name, CAST(tx_hash AS VARCHAR) AS tx_hash, vertical, protocol,
               amount_usd, CAST(block_date AS DATE) AS block_date
        FROM {src} WHERE {where}))
"""


# Silver over the label step's output (events named 'A' in that mapping).
SILVER_L = silver_from("lab_out", "A")


def labelled_as_bronze(src: str = "transfers_ev") -> str:
    """A transfer CTE conformed to the 21 labelled columns (NULL where absent)."""
    return f"""
SELECT CAST(NULL AS DOUBLE) AS amount, amount_usd, CAST(block_date AS VARCHAR) AS block_date,
       CAST(NULL AS VARCHAR) AS block_time, CAST(NULL AS VARCHAR) AS blockchain, event_name, protocol,
       CAST(NULL AS VARCHAR) AS receiver, CAST(NULL AS VARCHAR) AS receiver_contract_name,
       CAST(NULL AS VARCHAR) AS receiver_ens, CAST(NULL AS VARCHAR) AS receiver_label_categories,
       CAST(NULL AS VARCHAR) AS receiver_label_models, CAST(NULL AS VARCHAR) AS receiver_label_names,
       CAST(NULL AS VARCHAR) AS receiver_name, CAST(NULL AS VARCHAR) AS receiver_type,
       CAST(NULL AS VARCHAR) AS safe_sender, CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS VARCHAR) AS token_address,
       token_category, tx_hash, vertical
FROM {src}"""

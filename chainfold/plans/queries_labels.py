"""Queries over the ``lineitem`` mapping: the label step (SURVEY §2 keys
A9, C12-C15, D1-D7, E4, E5, I8-I12, J1-J9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfold.functions import text as X
from chainfold.operators import labels as L
from chainfold.operators import rules as R
from chainfold.operators.joins import materialize, membership_flag, two_sided_join
from chainfold.plans import oracle as O
from chainfold.plans.registry import query
from chainfold.plans.testdata import label_inputs
from chainfold.session import scratch_dir
from chainfold.sinks.files import write_label_tables
from chainfold.sources.tables import label_tables

RUN_DATE = "1998-05-15"  # the daily slice is the day before the run date


def _inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return label_inputs(spark, sf_dir)


def _safe(inp: dict[str, DataFrame]) -> DataFrame:
    """The wallets' transfers, computed once: they feed several steps and size checks."""
    return materialize(L.wallet_transfers(inp["transfers"], inp["wallets"]))


def _sql(*blocks: str, select: str) -> str:
    return O.with_(O.LABEL_INPUTS, *blocks) + "\n" + select


# ------------------------------------------------------------------- J1-J9


@query("wallet_transfers", _sql(O.SAFE_TRANSFERS, select="SELECT * FROM wallet_tx"))
def q_wallet_transfers(spark, sf_dir):
    return _safe(_inputs(spark, sf_dir))


@query("receiver_labels", _sql(O.SAFE_TRANSFERS, O.RECEIVER_FACTS, select="SELECT * FROM recv_info"))
def q_receiver_labels(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return L.receiver_labels(L.receivers(_safe(inp)), inp["ens"], inp["contracts"], inp["addresses"])


@query("receiver_labels_bucketed", _sql(O.SAFE_TRANSFERS, O.RECEIVER_FACTS, select="SELECT * FROM recv_info"))
def q_receiver_labels_bucketed(spark, sf_dir):
    """The same over bucketed label tables: only the receivers are shuffled."""
    inp = _inputs(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = write_label_tables(spark, {r: inp[r] for r in ("ens", "contracts", "addresses")}, scratch_dir(spark, "labels"), buckets)
    return L.bucketed_receiver_labels(L.receivers(_safe(inp)), **tables)


@query("event_names", _sql(O.SAFE_TRANSFERS, O.RECEIVER_FACTS, select="SELECT * FROM tx_events"))
def q_event_names(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return L.event_names(inp["logs"], _safe(inp))


@query(
    "token_category",
    _sql(
        O.SAFE_TRANSFERS,
        select="""SELECT t.tx_hash, t.evt_index, t.blockchain, t.contract_address,
  CASE WHEN s.stablecoin_address IS NOT NULL THEN 'stablecoin' ELSE t.token_standard END AS token_category
FROM wallet_tx t LEFT JOIN stablecoins s
  ON s.blockchain = t.blockchain AND s.stablecoin_address = t.contract_address""",
    ),
)
def q_token_category(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    j = L.stablecoin_flag(_safe(inp), inp["stablecoins"])
    return j.select(
        "tx_hash",
        "evt_index",
        "blockchain",
        "contract_address",
        R.token_category(F.col("is_stablecoin"), F.col("token_standard")).alias("token_category"),
    )


@query(
    "receiver_type",
    _sql(
        O.SAFE_TRANSFERS,
        select="""SELECT tx_hash, evt_index, "to",
  CASE WHEN "to" IN (SELECT address FROM wallets) THEN 'Safe'
       WHEN "to" IN (SELECT address FROM burn_list) THEN 'Burner address'
       WHEN "to" IN (SELECT address FROM created) THEN 'Smart contract'
       ELSE 'EOA' END AS receiver_type
FROM wallet_tx""",
    ),
)
def q_receiver_type(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    return L.receiver_types(_safe(inp), inp).select("tx_hash", "evt_index", "to", "receiver_type")


_PER_RECEIVER_SQL = """SELECT DISTINCT blockchain, receiver, receiver_contract_name, receiver_name{extra} FROM lab_out"""


def _per_receiver(spark, sf_dir, cols):
    cols = ["blockchain", "receiver", *cols]
    return L.label_transfers(_inputs(spark, sf_dir), columns=cols).select(*cols).distinct()


@query("receiver_name", O.LABEL_ALL + "\n" + _PER_RECEIVER_SQL.format(extra=""))
def q_receiver_name(spark, sf_dir):
    return _per_receiver(spark, sf_dir, ["receiver_contract_name", "receiver_name"])


@query(
    "classify_vertical",
    O.LABEL_ALL + "\nSELECT DISTINCT blockchain, receiver, receiver_type, receiver_name, vertical FROM lab_out",
)
def q_classify_vertical(spark, sf_dir):
    return _per_receiver(spark, sf_dir, ["receiver_type", "receiver_name", "vertical"])


@query(
    "derive_protocol",
    O.LABEL_ALL + "\nSELECT DISTINCT blockchain, receiver, receiver_type, protocol FROM lab_out",
)
def q_derive_protocol(spark, sf_dir):
    return _per_receiver(spark, sf_dir, ["receiver_type", "protocol"]).select(
        "blockchain", "receiver", "receiver_type", "protocol"
    )


@query("labelled_transfers", O.LABEL_ALL + "\n" + O.LABELLED_21)
def q_labelled_transfers(spark, sf_dir):
    return L.to_labelled_schema(L.label_transfers(_inputs(spark, sf_dir)))


@query("labelled_transfers_address_join", O.LABEL_ALL_ADDRESS_JOIN + "\n" + O.LABELLED_21)
def q_labelled_transfers_address_join(spark, sf_dir):
    """The label step with the original address-only label join (fan-out
    across chains kept)."""
    return L.to_labelled_schema(L.label_transfers(_inputs(spark, sf_dir), same_chain=False))


@query(
    "vertical_counts",
    O.LABEL_ALL
    + "\nSELECT vertical, receiver_type, COUNT(*) AS n_transfers, CAST(SUM(amount_usd) AS DECIMAL(38,2)) AS usd"
    " FROM lab_out GROUP BY vertical, receiver_type",
)
def q_vertical_counts(spark, sf_dir):
    lab = L.label_transfers(_inputs(spark, sf_dir), columns=["vertical", "receiver_type", "amount_usd"])
    return lab.groupBy("vertical", "receiver_type").agg(
        F.count(F.lit(1)).alias("n_transfers"), F.sum(F.col("amount_usd").cast("decimal(38,2)")).alias("usd")
    )


# -------------------------------------------------------- single operators


@query(
    "filter_previous_day",
    _sql(select=f"SELECT * FROM tr WHERE block_date = DATE '{RUN_DATE}' - INTERVAL 1 DAY"),
)
def q_filter_previous_day(spark, sf_dir):
    return L.previous_day_transfers(_inputs(spark, sf_dir)["transfers"], RUN_DATE)


@query("filter_in_list", _sql(O.USABLE_LABELS, select="FROM usable"))
def q_filter_in_list(spark, sf_dir):
    return _inputs(spark, sf_dir)["addresses"].where(R.label_kept())


@query(
    "filter_like",
    _sql(select="SELECT * FROM contracts WHERE name LIKE '%Gnosis_safe%' OR lower(name) LIKE '%swap%'"),
)
def q_filter_like(spark, sf_dir):
    c = _inputs(spark, sf_dir)["contracts"]
    return c.where(X.contains_like("name", R.SAFE_CONTRACT_PATTERN) | X.contains_like(X.lower("name"), R.SWAP_PATTERN))


@query(
    "case_when",
    _sql(
        select="""SELECT address, blockchain, name,
  CASE WHEN model_name = 'burn_addresses' THEN 'burn address' WHEN model_name = 'cex_ethereum' THEN 'CEX'
       WHEN category = 'bridge' THEN 'bridge' ELSE 'other' END AS kind
FROM addresses""",
    ),
)
def q_case_when(spark, sf_dir):
    a = _inputs(spark, sf_dir)["addresses"]
    kind = (
        F.when(F.col("model_name") == R.BURN_MODEL, F.lit(R.BURN_VERTICAL))
        .when(F.col("model_name") == R.CEX_MODEL, F.lit(R.CEX_VERTICAL))
        .when(F.col("category") == R.BRIDGE_CATEGORY, F.lit("bridge"))
        .otherwise(F.lit("other"))
    )
    return a.select("address", "blockchain", "name", kind.alias("kind"))


@query(
    "join_left_single_key",
    _sql(
        O.SAFE_TRANSFERS,
        select='SELECT t.tx_hash, t.evt_index, t."to", e.name AS ens FROM wallet_tx t LEFT JOIN ens e ON e.address = t."to"',
    ),
)
def q_join_left_single_key(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    e = inp["ens"].select(F.col("address").alias("to"), F.col("name").alias("ens"))
    return _safe(inp).join(e, "to", "left").select("tx_hash", "evt_index", "to", "ens")


@query(
    "join_left_multi_key",
    _sql(
        O.SAFE_TRANSFERS,
        select="""SELECT t.tx_hash, t.evt_index, t."to", t.blockchain, c.name AS contract_name
FROM wallet_tx t LEFT JOIN contracts c ON c.address = t."to" AND c.blockchain = t.blockchain""",
    ),
)
def q_join_left_multi_key(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    c = inp["contracts"].select(
        F.col("address").alias("to"), "blockchain", F.col("name").alias("contract_name")
    )
    return _safe(inp).join(c, ["to", "blockchain"], "left").select(
        "tx_hash", "evt_index", "to", "blockchain", "contract_name"
    )


@query(
    "join_left_filtered_right",
    _sql(
        O.SAFE_TRANSFERS,
        O.USABLE_LABELS,
        select=f"""SELECT t.tx_hash, t.evt_index, t."to", t.blockchain, al.name AS label_name, al.model_name
FROM wallet_tx t LEFT JOIN usable al ON al.address = t."to" AND al.blockchain = t.blockchain""",
    ),
)
def q_join_left_filtered_right(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    la = (
        inp["addresses"]
        .where(R.label_kept())
        .select(F.col("address").alias("to"), "blockchain", F.col("name").alias("label_name"), "model_name")
    )
    return _safe(inp).join(la, ["to", "blockchain"], "left").select(
        "tx_hash", "evt_index", "to", "blockchain", "label_name", "model_name"
    )


@query("join_semi", _sql(select='SELECT * FROM tr WHERE "from" IN (SELECT address FROM wallets)'))
def q_join_semi(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    w = inp["wallets"].select(F.col("address").alias("from"))
    return inp["transfers"].join(w, "from", "left_semi")


@query(
    "join_existence",
    _sql(
        select="""SELECT tx_hash, evt_index, "to", COALESCE("to" IN (SELECT address FROM created), false) AS is_contract
FROM tr""",
    ),
)
def q_join_existence(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    t = inp["transfers"].select("tx_hash", "evt_index", "to")
    return membership_flag(t, "to", inp["creation"], "address", "is_contract").select(
        "tx_hash", "evt_index", "to", "is_contract"
    )


@query(
    "join_star",
    _sql(
        O.SAFE_TRANSFERS,
        O.RECEIVER_FACTS,
        select="""SELECT t.tx_hash, t.evt_index, t.blockchain, t."to", s.stablecoin_address IS NOT NULL AS is_stablecoin,
  ri.label_names, ri.contract_name, ri.ens, ev.event_name
FROM wallet_tx t
LEFT JOIN stablecoins s ON s.blockchain = t.blockchain AND s.stablecoin_address = t.contract_address
LEFT JOIN recv_info ri ON ri.address = t."to" AND ri.blockchain = t.blockchain
LEFT JOIN tx_events ev ON ev.tx_hash = t.tx_hash AND ev."index" = t.evt_index""",
    ),
)
def q_join_star(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    t = _safe(inp)
    lab = materialize(L.receiver_labels(L.receivers(t), inp["ens"], inp["contracts"], inp["addresses"]))
    evt = L.event_names(inp["logs"], t).withColumnRenamed("index", "evt_index")
    j = two_sided_join(t, materialize(evt), ["tx_hash", "evt_index"], "left")
    j = L.attach_receiver_info(L.stablecoin_flag(j, inp["stablecoins"]), lab)
    return j.select(
        "tx_hash", "evt_index", "blockchain", "to", "is_stablecoin", "label_names", "contract_name", "ens", "event_name"
    )


@query(
    "agg_min_strings",
    _sql(
        select="""SELECT blockchain, address, MIN(name) AS min_name, MIN(category) AS min_category,
  MIN(model_name) AS min_model_name, MIN(label_type) AS min_label_type
FROM addresses GROUP BY blockchain, address""",
    ),
)
def q_agg_min_strings(spark, sf_dir):
    a = _inputs(spark, sf_dir)["addresses"]
    return a.groupBy("blockchain", "address").agg(
        *[F.min(c).alias(f"min_{c}") for c in ("name", "category", "model_name", "label_type")]
    )


@query("select_distinct", _sql(select='SELECT DISTINCT tx_hash, "index", event_name FROM logs'))
def q_select_distinct(spark, sf_dir):
    return _inputs(spark, sf_dir)["logs"].select("tx_hash", "index", "event_name").distinct()


@query("str_lower", _sql(select="SELECT address, blockchain, lower(name) AS name_lower FROM contracts"))
def q_str_lower(spark, sf_dir):
    c = _inputs(spark, sf_dir)["contracts"]
    return c.select("address", "blockchain", X.lower("name").alias("name_lower"))


@query(
    "str_concat",
    _sql(
        select="""SELECT address, blockchain, 'Safe: ' || split_part(name, ':', 1) AS dao_name,
  'unclassified transfer to ' || CASE WHEN category = 'x' THEN NULL ELSE category END AS strict_concat
FROM addresses""",
    ),
)
def q_str_concat(spark, sf_dir):
    a = _inputs(spark, sf_dir)["addresses"]
    cat = F.when(F.col("category") == "x", F.lit(None).cast("string")).otherwise(F.col("category"))
    return a.select(
        "address",
        "blockchain",
        X.concat_strict(R.DAO_NAME_PREFIX, X.first_part("name", ":")).alias("dao_name"),
        R.unclassified(cat).alias("strict_concat"),
    )


@query(
    "str_split_part",
    _sql(select="SELECT address, blockchain, split_part(name, ': ', 1) AS project, split_part(name, ':', 1) AS head FROM contracts"),
)
def q_str_split_part(spark, sf_dir):
    c = _inputs(spark, sf_dir)["contracts"]
    return c.select(
        "address",
        "blockchain",
        X.first_part("name", ": ").alias("project"),
        X.first_part("name", ":").alias("head"),
    )


@query(
    "coalesce_cols",
    _sql(
        O.SAFE_TRANSFERS,
        O.RECEIVER_FACTS,
        select="SELECT blockchain, address, COALESCE(contract_name, label_names, ens) AS any_name FROM recv_info",
    ),
)
def q_coalesce_cols(spark, sf_dir):
    inp = _inputs(spark, sf_dir)
    lab = L.receiver_labels(L.receivers(_safe(inp)), inp["ens"], inp["contracts"], inp["addresses"])
    return lab.select("blockchain", "address", X.first_non_null("contract_name", "label_names", "ens").alias("any_name"))


@query(
    "str_trim",
    _sql(select="SELECT address, trim(' ' || name || '  ') AS name_trimmed FROM ens"),
)
def q_str_trim(spark, sf_dir):
    e = _inputs(spark, sf_dir)["ens"]
    return e.select("address", X.trim(X.concat_strict(" ", F.col("name"), "  ")).alias("name_trimmed"))


_COUNT_SQL = {
    "transfers": "tr",
    "wallets": "wallets",
    "ens": "ens",
    "contracts": "contracts",
    "addresses": "addresses",
    "logs": "logs",
    "burn": "burn_list",
    "creation": "created",
    "stablecoins": "stablecoins",
    "stakers": "stakers",
}


_KEYS = {"transfers": "tx_hash", "logs": "tx_hash", "stablecoins": "stablecoin_address"}


@query(
    "scan_label_tables",
    _sql(
        select="\nUNION ALL\n".join(
            f"SELECT '{k}' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT {_KEYS.get(k, 'address')}) AS n_keys FROM {v}"
            for k, v in _COUNT_SQL.items()
        )
    ),
)
def q_scan_label_tables(spark, sf_dir):
    """All ten tables, written and read back by role."""
    paths = {}
    for role, df in _inputs(spark, sf_dir).items():
        paths[role] = scratch_dir(spark, f"label-{role}")
        df.write.parquet(paths[role])
    out = None
    for role, df in label_tables(spark, paths).items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(_KEYS.get(role, "address")).alias("n_keys"))
        c = c.select(F.lit(role).alias("table_name"), "n_rows", "n_keys")
        out = c if out is None else out.unionByName(c)
    return out

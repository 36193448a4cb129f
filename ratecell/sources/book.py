"""The fixture book: reference-shaped insurance tables derived from the driver's tables.

The exhibits expect TRX, inforce, closing and retention tables that do not
exist here, so this module derives them from ``lineitem ⋈ orders ⋈ customer ⋈
nation ⋈ region ⋈ part`` (one book row per line item). The derivation is a
list of SQL expressions written in the subset of SQL that Spark and DuckDB
read the same way, so Spark applies them with ``selectExpr`` and the DuckDB
oracle embeds the very same text in a CTE: both engines start from identical
inputs, and only the exhibit logic under test differs.

Value design, so that sums are exact in any order (and therefore equal across
engines): money is integer-valued, exposures are quarters, shares are
sixteenths and the proposed factor is in 64ths - all binary fractions.

Keys: ``(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate)`` is unique
in the driver data, so driver ids combine line, part and supplier and the
12-key TRX join and the 4-key inforce join never fan out.

Mapping: policy/account = customer, vehicle = order, driver = line item,
jurisdiction = region, company from order priority, FSA from part brand.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecell.sources.sinks import materialize, materialize_bucketed
from ratecell.sources.tables import read_table

# Row is the joined line item; every column name is unique across the six tables.
JOIN_SQL = ("lineitem JOIN orders ON l_orderkey = o_orderkey "
            "JOIN customer ON o_custkey = c_custkey "
            "JOIN nation ON c_nationkey = n_nationkey "
            "JOIN region ON n_regionkey = r_regionkey "
            "JOIN part ON l_partkey = p_partkey")

# Rows absent from the proposed side (a proposed-side row that does not match
# counts as a 100% decrease after the left join).
PROPOSED_MISSING = "l_linenumber = 6 AND l_returnflag = 'R'"

# Level 1: helper values.
_K = [
    ("k_brand", "CAST(substr(p_brand, 7) AS INT)"),
    ("k_tax", "CAST(ROUND(l_tax * 100) AS INT)"),
    ("k_disc", "CAST(ROUND(l_discount * 100) AS INT)"),
    ("k_base", "CASE WHEN o_orderkey % 89 = 0 THEN 0e0 "
               "ELSE CAST(FLOOR(l_extendedprice) AS DOUBLE) END"),
    ("k_claim", "CAST(FLOOR(l_extendedprice * l_discount) AS DOUBLE)"),
    ("k_xpo", "CAST(CAST(l_quantity AS INT) % 4 + 1 AS DOUBLE) / 4e0"),
    ("k_prop", "(54e0 + 3e0 * CAST(ROUND(l_tax * 100) AS INT)) / 64e0"),
]

_FSA = ("CASE WHEN k_brand >= 24 THEN concat('Z', CAST(k_brand AS STRING)) "
        "ELSE concat(substr('ABCEGHJKLMNPRSTVXY', k_brand % 18 + 1, 1), "
        "CAST(k_brand % 10 AS STRING), substr('ABCEGHJKLMNPRSTVWXYZ', k_brand % 20 + 1, 1)) END")

# Level 2: the book columns shared by all roles.
_COMMON = [
    ("pol_insurer_no", "c_nationkey"),
    ("clt_account_no", "o_custkey"),
    ("pol_policy_no", "o_custkey"),
    ("veh_id_no", "o_orderkey"),
    ("dri_id_no", "concat_ws('-', CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), "
                  "CAST(l_suppkey AS STRING), CAST(l_shipdate AS STRING))"),
    ("vehicle_driver_version_key", "concat_ws('-', CAST(l_partkey AS STRING), "
                                   "CAST(l_suppkey AS STRING))"),
    ("pol_eff_dt", "o_orderdate"),
    ("trx_eff_dt", "l_shipdate"),
    ("trx_ent_dt", "l_shipdate"),
    ("pol_acc_yr_dt", "CAST(year(o_orderdate) AS STRING)"),
    ("trx_offset_onset_cd", "CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE l_linestatus END"),
    ("dat_as_of_dt", "CASE WHEN o_orderkey % 43 = 0 THEN '2025-03-31' ELSE '2025-06-30' END"),
    ("dat_year_type_tx", "CASE WHEN l_suppkey % 19 = 0 THEN 'CY' ELSE 'AY' END"),
    ("pol_jurisdiction_cd", "r_name"),
    ("pol_region_cd", "CASE WHEN r_name = 'MIDDLE EAST' THEN 'QC' ELSE 'AP' END"),
    ("pol_uwcompany_cd", "CASE WHEN o_orderkey % 53 = 0 THEN NULL "
                         "WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'snic' "
                         "WHEN o_orderpriority = '3-MEDIUM' THEN 'prim' ELSE 'other' END"),
    ("dri_type_cd", "CASE l_linenumber WHEN 1 THEN 'Principal' "
                    "WHEN 2 THEN 'OccasionalPrincipal' WHEN 7 THEN NULL ELSE 'Occasional' END"),
    ("veh_fsa_tx", f"CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' "
                   f"WHEN 2 THEN concat(lower({_FSA}), ' ') WHEN 3 THEN concat('  ', {_FSA}) "
                   f"ELSE {_FSA} END"),
    ("veh_product_cd", "CASE p_type WHEN 'SMALL' THEN 'motor_home' WHEN 'PROMO' THEN 'trailer' ELSE 'ppa' END"),
    ("pol_commercial_in", "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END"),
    ("pol_business_cd", "CASE WHEN o_orderstatus = 'O' THEN 'NB' ELSE 'RN' END"),
    # rating variables
    ("rat_km_annual_nb", "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE l_quantity * 500e0 END"),
    ("rat_km_work_nb", "CAST(l_quantity AS INT) - 10"),
    ("rat_km_business_nb", "CAST(l_quantity AS INT) % 3 - 1"),
    ("number_au_mh", "CAST(o_orderkey % 12 AS INT)"),
    ("number_veh_in_family", "CAST(o_orderkey % 12 + o_custkey % 3 AS INT)"),
    ("veh_dri_onp_nb", "l_linenumber - 1"),
    ("veh_age_nb", "p_size % 15"),
    ("veh_vicc_price_am", "CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 13 = 1 THEN 0e0 "
                          "ELSE l_extendedprice * 2e0 END"),
    ("clt_p_holder_credit_score_no", "CASE WHEN p_partkey % 17 = 0 THEN 'NA' "
                                     "WHEN p_partkey % 17 = 1 THEN NULL "
                                     "ELSE CAST(p_size * 20 AS STRING) END"),
    ("dri_gender_cd", "CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END"),
    ("dri_yrs_licensed_au_nb", "CAST(o_custkey % 40 AS INT)"),
    ("veh_rg_ab_no", "p_size % 7 + 1"),
    ("veh_rg_dc_no", "p_size % 9 + 1"),
    ("veh_rg_col_no", "p_size % 11 + 1"),
    ("veh_rg_cmp_no", "k_brand % 8 + 1"),
    ("cov_col_ded_am", "CASE WHEN p_size % 4 = 0 THEN NULL ELSE 500e0 * (p_size % 4) END"),
    ("cov_cmp_ded_am", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE 250e0 * (p_size % 5) END"),
    ("cov_tpl_limit_am", "CASE WHEN o_custkey % 3 = 0 THEN 1000000 ELSE 2000000 END"),
    ("exp_col_af_10yrs_nb", "CASE WHEN k_tax = 5 THEN NULL ELSE k_tax % 3 END"),
    ("exp_col_af_10yrs_avg_nb", "CASE WHEN k_tax = 5 THEN NULL ELSE k_tax % 2 END"),
    ("exp_minor_03yrs_avg_nb", "CASE WHEN k_disc = 9 THEN NULL ELSE k_disc % 3 END"),
    ("exp_major_03yrs_nb", "CASE WHEN k_disc = 7 THEN NULL ELSE k_disc % 2 END"),
    ("exp_criminal_03yrs_nb", "CASE WHEN o_custkey % 29 = 0 THEN 1 ELSE 0 END"),
    ("exp_susp_minus_03yrs_nb", "CAST(o_custkey % 4 AS INT)"),
    ("exp_susp_plus_03yrs_nb", "CAST(o_custkey % 2 AS INT)"),
    ("exp_canc_nopay_03yrs_nb", "CASE WHEN k_disc = 3 THEN 1 ELSE 0 END"),
    ("ter_onlvl_ibc_no", "n_nationkey % 6 + 1"),
    ("exp_minor_03yrs_nb", "CASE WHEN k_disc = 10 THEN NULL ELSE k_disc % 4 END"),
    # coverage indicators (AP excludes COL/CMP/SPE, save for a few rows that the double-count guard finds)
    ("cov_bi_in", "1"),
    ("cov_dc_in", "1"),
    ("cov_pd_in", "CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END"),
    ("cov_ab_in", "1"),
    ("cov_ap_in", "CASE WHEN p_size % 9 = 0 THEN 1 ELSE 0 END"),
    ("cov_col_in", "CASE WHEN o_orderkey % 37 = 0 THEN NULL "
                   "WHEN o_orderkey % 59 = 0 OR (p_size % 9 <> 0 AND p_size % 2 = 0) THEN 1 ELSE 0 END"),
    ("cov_cmp_in", "CASE WHEN p_size % 9 <> 0 AND p_size % 3 = 0 THEN 1 ELSE 0 END"),
    ("cov_spe_in", "CASE WHEN p_size % 9 <> 0 AND p_size % 3 <> 0 AND p_size % 5 = 0 "
                   "THEN 1 ELSE 0 END"),
    # loss costs and demand scores
    ("lc_losscost_bi_pred_am", "k_claim * 0.25e0"),
    ("lc_losscost_pd_pred_am", "k_claim * 0.125e0"),
    ("lc_losscost_dc_pred_am", "k_claim * 0.125e0"),
    ("lc_losscost_ab_pred_am", "k_claim * 0.125e0"),
    ("lc_losscost_col_pred_am", "k_claim * 0.125e0"),
    ("lc_losscost_cmp_pred_am", "k_claim * 0.125e0"),
    ("lc_losscost_total_pred_am", "k_claim"),
    ("rat_fulldemand_closing_fc", "CASE WHEN o_orderkey % 41 = 0 THEN NULL "
                                  "ELSE (16e0 + k_disc) / 64e0 END"),
    ("rat_fulldemand_ft_retention_fc", "(48e0 + k_tax) / 64e0"),
    ("rat_fulldemand_mt_retention_fc", "(52e0 + l_linenumber % 4) / 64e0"),
    # claims (current-side values; the summary only takes premiums from the proposed side)
    ("clm_chap_tpl_nb", "CASE WHEN k_disc >= 9 THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_bi_nb", "CASE WHEN k_disc = 10 THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_dc_nb", "CASE WHEN k_disc = 8 THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_pd_nb", "CASE WHEN k_disc IN (6, 7) THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_ab_nb", "CASE WHEN k_tax = 8 THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_col_nb", "CASE WHEN k_tax >= 7 THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_cmp_nb", "CASE WHEN k_tax = 0 THEN 1e0 ELSE 0e0 END"),
    ("clm_chap_tpl_cap500k_am", "k_claim * 0.5e0"),
    ("clm_chap_bi_cap500k_am", "k_claim * 0.25e0"),
    ("clm_chap_pd_cap500k_am", "k_claim * 0.125e0"),
    ("clm_chap_pd_am", "k_claim * 0.1875e0"),
    ("clm_chap_dc_am", "k_claim * 0.125e0"),
    ("clm_chap_ab_cap500k_am", "k_claim * 0.125e0"),
    ("clm_chap_um_am", "k_claim * 0.0625e0"),
    ("clm_chap_col_am", "k_claim * 0.125e0"),
    ("clm_chap_cmp_am", "k_claim * 0.0625e0"),
    ("clm_chap_ui_am", "k_claim * 0.0625e0"),
    # vehicle code (CLEAR lookup key)
    ("veh_vicc_cd", "CAST(l_partkey AS STRING)"),
    # scored TRX before earning: AP portions, raw COL/CMP, endorsements, earned exposures
    ("Coll_Portion_of_AP", "CASE WHEN p_size % 9 = 0 THEN k_base * 0.0625e0 ELSE 0e0 END"),
    ("Comp_Portion_of_AP", "CASE WHEN p_size % 9 = 0 THEN k_base * 0.03125e0 ELSE 0e0 END"),
    ("Prm_Trm_COL_Uncap_Am", "k_base * 0.125e0"),
    ("Prm_Trm_CMP_Uncap_Am", "k_base * 0.0625e0"),
] + [(f"Prm_Trm_End_{e}_Uncap_Am",
      f"CASE WHEN (l_linenumber + {i}) % 3 = 0 THEN NULL ELSE k_base * 0.015625e0 END")
     for i, e in enumerate(["02", "06", "16", "20", "23B", "27", "27S", "38", "43", "43R", "43S",
                            "60S", "70"])] + [
    (f"xpo_ern_chap_{c}_nb", "k_xpo") for c in ["tpl", "bi", "pd", "dc", "ab", "um", "ui"]] + [
    ("xpo_ern_chap_col_nb", "CASE WHEN p_size % 2 = 0 THEN k_xpo ELSE 0e0 END"),
    ("xpo_ern_chap_cmp_nb", "CASE WHEN p_size % 3 = 0 THEN k_xpo ELSE 0e0 END"),
    ("xpo_ern_chap_ap_nb", "CASE WHEN p_size % 9 = 0 THEN k_xpo ELSE 0e0 END"),
    ("xpo_ern_chap_spe_nb", "CASE WHEN p_size % 5 = 0 THEN k_xpo ELSE 0e0 END"),
]

# FIXED (book design): coverage shares of the line premium, in sixteenths.
SHARES = [("BI", "0.25e0"), ("PD", "0.125e0"), ("DC", "0.125e0"), ("AB", "0.125e0"),
          ("UA", "0.0625e0"), ("AP_COL", "0.125e0"), ("AP_SP_CMP", "0.0625e0"),
          ("SP", "0.0625e0"), ("UI", "0.0625e0")]
NULL_BI = "o_orderkey % 97 = 0"   # rows whose BI premium is missing


def _side_columns(f: str) -> list[tuple[str, str]]:
    """Premium columns, scaled by the side factor ``f`` ('1e0' or 'k_prop')."""
    out = []
    for cov, share in SHARES:
        v = f"k_base * {share} * {f}"
        out.append((f"Prm_Trm_{cov}_Uncap_Am",
                    f"CASE WHEN {NULL_BI} THEN NULL ELSE {v} END" if cov == "BI" else v))
    out.append(("Prm_Trm_Dri_Tot_Uncap_Am", f"k_base * {f}"))
    out.append(("Prm_Trm_Dri_Base_Uncap_Am", f"k_base * 0.9375e0 * {f}"))
    for cov, share in SHARES:
        if cov == "SP":
            continue
        out.append((f"Prm_Ern_{cov}_OnLvl_Am", f"k_base * {share} * k_xpo * {f}"))
    for cov in ["BI", "PD", "DC", "AB", "AP_COL", "AP_SP_CMP"]:
        share = dict(SHARES)[cov]
        v = f"k_base * {share} * k_xpo * 1.0625e0 * {f}"
        out.append((f"Prm_Ern_{cov}_OnLvl_End_Am",
                    f"CASE WHEN {NULL_BI} THEN NULL ELSE {v} END" if cov == "BI" else v))
        out.append((f"Xpo_Ern_{cov}_Nb", "k_xpo"))
    return out


def book_columns(side: str = "current") -> list[tuple[str, str]]:
    f = "1e0" if side == "current" else "k_prop"
    return _COMMON + _side_columns(f)


def joined(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The six driver tables joined to one row per line item (inner, equi joins). Orders meet their customers
    and line items their parts before the two meet, so that line items are moved at most twice, never with the
    columns of four tables; nation and region are 25 and 5 rows, so the planner broadcasts them.
    ``partitions``: the last join moves both into that many by order, else as the planner chooses."""
    t = {n: read_table(spark, sf_dir, n)
         for n in ["lineitem", "orders", "customer", "nation", "region", "part"]}
    orders = (t["orders"]
              .join(t["customer"], t["orders"]["o_custkey"] == t["customer"]["c_custkey"])
              .join(t["nation"], t["customer"]["c_nationkey"] == t["nation"]["n_nationkey"])
              .join(t["region"], t["nation"]["n_regionkey"] == t["region"]["r_regionkey"]))
    lines = t["lineitem"].join(t["part"], t["lineitem"]["l_partkey"] == t["part"]["p_partkey"])
    if partitions:
        lines, orders = lines.repartition(partitions, "l_orderkey"), orders.repartition(partitions, "o_orderkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def _derived(spark: SparkSession, sf_dir: str, cols: list[tuple[str, str]],
             where: str | None = None, rows: DataFrame | None = None) -> DataFrame:
    rows = joined(spark, sf_dir) if rows is None else rows
    if where:
        rows = rows.filter(where)
    level1 = rows.selectExpr("*", *[f"{e} AS {n}" for n, e in _K])
    return level1.selectExpr(*[f"{e} AS {n}" for n, e in cols])


def book(spark: SparkSession, sf_dir: str, side: str = "current", rows: DataFrame | None = None) -> DataFrame:
    """One side of the book as a Spark DataFrame (lazy; Catalyst prunes unused columns). ``rows``: the
    joined line items, if they are written already (``written_rows``)."""
    where = None if side == "current" else f"NOT ({PROPOSED_MISSING})"
    return _derived(spark, sf_dir, book_columns(side), where, rows)


Keep = Callable[[DataFrame, list[str]], DataFrame]


def written_rows(spark: SparkSession, sf_dir: str, keep: Keep | None = None) -> DataFrame:
    """The joined line items with the columns that the book is made of, written once: for jobs that read the
    book several times, each of which would join the six tables anew. ``keep``: an extract of the book, given the
    columns to select, for jobs that read no other rows; its filters reach the tables before they are joined."""
    return materialize(_kept(joined(spark, sf_dir), keep), "book_rows")


def _kept(rows: DataFrame, keep: Keep | None) -> DataFrame:
    used = _used(rows)
    if keep is None:
        return used
    level1 = rows.selectExpr("*", *[f"{e} AS {n}" for n, e in _K])
    return keep(level1.selectExpr(*used.columns, *[f"{e} AS {n}" for n, e in book_columns()]), used.columns)


def _used(d: DataFrame) -> DataFrame:
    """The columns that the book is made of."""
    used = set(re.findall(r"\b[a-z]+_[a-z]+\b", " ".join(e for _, e in _K + book_columns("proposed")) + PROPOSED_MISSING))
    return d.select(*[c for c in d.columns if c in used])


# A vehicle is hot if it may hold more than this share of all rows, and this many.
HOT_SHARE, HOT_ROWS = 1 / 500, 100_000
SLOTS = 4096
BUCKET_ROWS = 500_000


def _vehicle_sizes(spark: SparkSession, sf_dir: str) -> tuple[int, bool]:
    """Number of line items, and whether some slot of a fixed number of hashed vehicle ids holds so many
    line items or orders that one of its vehicles may be hot."""
    found = []
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        t = read_table(spark, sf_dir, name).select(key).where(F.col(key).isNotNull())
        size = t.groupBy(F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        found.append(size.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first())
    return found[0][0], any(most > max(HOT_ROWS, rows * HOT_SHARE) for rows, most in found)


def vehicle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``written_rows`` bucketed by vehicle, for exhibits that join the book's sides and sum by vehicle: the
    sides are joined and summed bucket by bucket, without an exchange. With a hot vehicle, which one bucket
    would hold whole, the rows are written without buckets, and the sides are moved by all their keys."""
    return vehicle_rows_buckets(spark, sf_dir)[0]


def vehicle_rows_buckets(spark: SparkSession, sf_dir: str, keep: Keep | None = None) -> tuple[DataFrame, int | None]:
    """``vehicle_rows`` and the number of its buckets, ``None`` if there are none. ``keep``: as for ``written_rows``."""
    rows, hot = _vehicle_sizes(spark, sf_dir)
    if hot:
        return written_rows(spark, sf_dir, keep), None
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * max(1, -(-rows // (BUCKET_ROWS * partitions)))      # a partition holds whole buckets
    return materialize_bucketed(_kept(joined(spark, sf_dir, buckets), keep), "book_rows", "o_orderkey", buckets), buckets


def book_sql(side: str = "current") -> str:
    """The same side of the book as DuckDB SQL over the pre-registered tables."""
    where = "" if side == "current" else f" WHERE NOT ({PROPOSED_MISSING})"
    k = ", ".join(f"{e} AS {n}" for n, e in _K)
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in book_columns(side))
    return f"SELECT\n  {cols}\nFROM (SELECT *, {k} FROM {JOIN_SQL}{where}) k"


# --- closing view and retention table ---------------------------------------------
_CLOSING = [
    ("pol_quote_no", "concat('Q-', CAST(o_orderkey AS STRING))"),
    ("clo_bound_in", "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 0 ELSE NULL END"),
    ("clt_veh_au_nb", "CAST(o_orderkey % 9 AS INT)"),
    ("clt_veh_mh_nb", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS INT) END"),
]
_CLOSING_SKIP = {"number_au_mh", "number_veh_in_family"}


def closing_columns() -> list[tuple[str, str]]:
    return [(n, e) for n, e in _COMMON if n not in _CLOSING_SKIP
            and not n.startswith(("lc_", "clm_", "cov_", "rat_fulldemand"))] + _CLOSING


_RETENTION = [("pol_policy_no", "o_custkey"),
              ("retained_in", "CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END"),
              ("pol_jurisdiction_cd", "r_name"),
              ("dri_gender_cd", "CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END"),
              ("veh_age_nb", "p_size % 15"),
              ("ter_onlvl_ibc_no", "n_nationkey % 6 + 1")]


def closing(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Closing view: one quote (order) repeated over its vehicle x driver rows. ``rows``: as for ``book``."""
    return _derived(spark, sf_dir, closing_columns(), rows=rows)


def retention(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Retention table: policy key, retained flag and a few raw (unbanded) variables. ``rows``: as for ``book``."""
    return _derived(spark, sf_dir, _RETENTION, rows=rows)


def _derived_sql(cols: list[tuple[str, str]]) -> str:
    k = ", ".join(f"{e} AS {n}" for n, e in _K)
    body = ",\n  ".join(f"{e} AS {n}" for n, e in cols)
    return f"SELECT\n  {body}\nFROM (SELECT *, {k} FROM {JOIN_SQL}) k"


def closing_sql() -> str:
    return _derived_sql(closing_columns())


def retention_sql() -> str:
    return _derived_sql(_RETENTION)


# --- derived lookup tables ----------------------------------------------------------------
# Loss costs keyed like the scored loss-cost master: one row per version key x
# jurisdiction x product (max over the book rows sharing the key).
LOSS_COST_SOURCE = [("bi", "bi"), ("pd", "pd"), ("dc", "dc"), ("ab", "ab"), ("col", "coll"),
                    ("cmp", "comp"), ("total", "total")]


def loss_cost_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = book(spark, sf_dir)
    return (b.groupBy("vehicle_driver_version_key", "pol_jurisdiction_cd", "veh_product_cd",
                      "pol_region_cd")
            .agg(*[F.max(f"lc_losscost_{a}_pred_am").alias(f"lc_losscost_{s}_pred_rebase")
                   for a, s in LOSS_COST_SOURCE]))


def loss_cost_sql() -> str:
    aggs = ", ".join(f"MAX(lc_losscost_{a}_pred_am) AS lc_losscost_{s}_pred_rebase"
                     for a, s in LOSS_COST_SOURCE)
    keys = "vehicle_driver_version_key, pol_jurisdiction_cd, veh_product_cd, pol_region_cd"
    return f"SELECT {keys}, {aggs} FROM ({book_sql('current')}) GROUP BY {keys}"


# CLEAR vehicle rate groups by vehicle code, one table per year (from ``part``).
def clear_columns(year: int) -> list[tuple[str, str]]:
    return [("veh_vicc_cd", "CAST(p_partkey AS STRING)"),
            ("veh_rg_col_no", f"(p_size + {year}) % 11 + 1"),
            ("veh_rg_cmp_no", f"(p_size * 3 + {year}) % 8 + 1")]


def clear_table(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(
        *[f"{e} AS {n}" for n, e in clear_columns(year)])


def clear_sql(year: int) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in clear_columns(year)) + " FROM part"

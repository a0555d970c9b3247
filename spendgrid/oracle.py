"""DuckDB SQL for the correctness gate.

Each builder returns ANSI-ish SQL over the driver's pre-registered test
tables that must give the same rows as the matching Spark query in
``__spark_entry__``. The SQL restates the test-table mapping and each
operator independently (e.g. the calendar as the reference's cross join
instead of the per-key sequence the Spark operator uses).
"""

from __future__ import annotations

from spendgrid.operators import (CATEGORIES, FEATURE_CATEGORIES,
                                 TARGET_CATEGORIES, category_prefix)
from spendgrid.operators.snapshot import TRAILING_MONTHS
from spendgrid.plans.preparation import TEST_PARAMS
from spendgrid.sources.testdata import (DEFAULT_CURRENCY, PART_TYPE_CATEGORY,
                                        PRIORITY_CHANNEL, PRIORITY_CURRENCY)

P = TEST_PARAMS
KEYS = "elc_master_id, consumer_id, brand_id"


def _case(col: str, mapping: dict, default: str | None = None) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f"'{default}'" if default is not None else "NULL"
    return f"CASE {arms} ELSE {tail} END"


def units(x: str) -> str:
    return f"CAST(round(({x}) * CAST(1000000 AS DOUBLE)) AS BIGINT)"


def from_units(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / CAST(1000000 AS DOUBLE))"


def _ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def _lst(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def adapter_ctes() -> str:
    """The test tables in the reference's source schemas (mirror of
    spendgrid.sources.testdata)."""
    return f"""
src_product AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS sku_six_digit_identifier,
         {_case('p_type', PART_TYPE_CATEGORY)} AS major_category_name,
         p_brand AS category_name, p_name AS sub_category_name,
         'FERT' AS product_type_code
  FROM part),
src_brand AS (
  SELECT CAST(r_regionkey AS BIGINT) AS brand_id,
         upper(substr(r_name, 1, 2)) AS brand_cd, r_name AS brand_desc,
         'noam' AS cdp_region
  FROM region),
src_orders AS (
  SELECT o.*, c.c_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
src_header AS (
  SELECT c_name AS elc_master_id, o_custkey AS consumer_id,
         CAST(o_orderdate AS DATE) AS sale_dt, o_orderkey AS txn_id,
         o_totalprice AS usd_net_order_total,
         {_case('o_orderpriority', PRIORITY_CURRENCY, DEFAULT_CURRENCY)} AS currency_cd,
         {_case('o_orderpriority', PRIORITY_CHANNEL)} AS channel_cd,
         CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS loyalty_trans_flag,
         CASE WHEN o_orderkey % 71 = 19 THEN 'emea' ELSE 'noam' END AS cdp_region,
         CASE WHEN o_orderkey % 97 = 3 THEN 0 ELSE 1 END AS valid_ind,
         CASE WHEN o_custkey % 89 = 5 THEN 'N' ELSE 'Y' END AS consumer_valid_flag,
         CASE WHEN o_orderkey % 83 = 7 THEN 'Y' ELSE 'N' END AS mac_pro_flag,
         CASE WHEN o_orderkey % 79 = 11 THEN 0 ELSE 1 END AS visit_ind,
         CASE WHEN o_orderkey % 73 = 13 THEN 'D' WHEN o_orderkey % 73 <> 17 THEN 'U' END AS cdc
  FROM src_orders),
src_detail AS (
  SELECT CAST(o.o_orderdate AS DATE) AS sale_dt,
         {_case('o.o_orderpriority', PRIORITY_CHANNEL)} AS channel_cd,
         o.c_name AS elc_master_id, o.o_custkey AS consumer_id,
         CAST(n.n_regionkey AS BIGINT) AS brand_id, l.l_orderkey AS txn_id,
         l.l_linenumber AS sale_line_num,
         CASE WHEN l.l_returnflag = 'R' THEN 'RETURN' ELSE 'SALE' END AS src_txn_cd_desc,
         CAST(l.l_quantity AS INTEGER) AS net_item_qty,
         l.l_extendedprice AS usd_total_price,
         l.l_extendedprice * l.l_discount AS usd_discount_amount,
         lpad(CAST(l.l_partkey AS VARCHAR), 6, '0') || '-' || CAST(l.l_suppkey AS VARCHAR) AS product_sku,
         l.l_suppkey AS store_id,
         CASE WHEN l.l_linenumber = 7 THEN 'Return' ELSE 'Sale' END AS sale_line_type,
         CASE WHEN l.l_orderkey % 67 = 23 THEN 'emea' ELSE 'noam' END AS cdp_region,
         'Product ' || l.l_partkey AS product_desc, 'M' || (l.l_partkey % 5) AS master_category,
         'C' || (l.l_partkey % 25) AS category, 'S' || (l.l_partkey % 125) AS sub_category,
         CASE WHEN l.l_partkey % 3 <> 0 THEN 'A' || (l.l_partkey % 7) END AS subcategory_alter
  FROM lineitem l
  LEFT JOIN src_orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def sales_ctes() -> str:
    """Adapter + validated views + the four-way join (sales lines)."""
    return adapter_ctes() + f""",
vh AS (
  SELECT * FROM src_header
  WHERE elc_master_id IS NOT NULL AND consumer_id IS NOT NULL
    AND cdp_region = 'noam' AND valid_ind = 1 AND consumer_valid_flag = 'Y'
    AND mac_pro_flag = 'N' AND visit_ind = 1 AND cdc <> 'D'
    AND usd_net_order_total > 0 AND currency_cd IN ('USD', 'CAD')
    AND sale_dt > DATE '{P.start_date}'),
vd AS (
  SELECT * FROM src_detail
  WHERE elc_master_id IS NOT NULL AND consumer_id IS NOT NULL
    AND cdp_region = 'noam' AND sale_line_type = 'Sale'
    AND product_sku IS NOT NULL AND net_item_qty > 0
    AND sale_dt > DATE '{P.start_date}'),
bl AS (
  SELECT brand_id, brand_cd, brand_desc FROM src_brand
  WHERE cdp_region = 'noam' AND brand_cd NOT IN ({_lst(P.excluded_brand_codes)})),
cat_pairs AS (
  SELECT DISTINCT sku_six_digit_identifier, major_category_name FROM src_product
  WHERE major_category_name IS NOT NULL AND product_type_code = 'FERT'),
cm AS (
  SELECT sku_six_digit_identifier, major_category_name FROM (
    SELECT *, count(*) OVER (PARTITION BY sku_six_digit_identifier) AS cnt FROM cat_pairs)
  WHERE cnt = 1),
sd AS (
  SELECT d.sale_dt, d.channel_cd, d.txn_id, d.elc_master_id, d.consumer_id,
         d.brand_id, c.major_category_name AS major_category,
         h.usd_net_order_total AS header_sales_amount, h.loyalty_trans_flag,
         d.sale_line_num, d.src_txn_cd_desc, d.net_item_qty,
         d.usd_total_price AS sales_amount, d.usd_discount_amount, d.store_id,
         d.product_sku, d.product_desc, d.master_category, d.category,
         d.sub_category, d.subcategory_alter
  FROM vd d
  JOIN vh h ON d.txn_id = h.txn_id
  JOIN cm c ON substr(d.product_sku, 1, 6) = c.sku_six_digit_identifier
  JOIN bl b ON d.brand_id = b.brand_id)"""


def monthly_cte() -> str:
    cat_cols = ",\n         ".join(
        f"{from_units('sum(CASE WHEN major_category = ' + repr(c) + ' THEN ' + units('sales_amount') + ' ELSE 0 END)')} "
        f"AS {category_prefix(c)}_amount" for c in CATEGORIES)
    return f""",
ms AS (
  SELECT CAST(date_trunc('month', sale_dt) AS DATE) AS sale_month, {KEYS},
         {from_units('sum(' + units('sales_amount') + ')')} AS sales_amount,
         count(DISTINCT txn_id) AS txn_cnt, count(*) AS item_cnt,
         {cat_cols}
  FROM sd WHERE sale_dt < DATE '{P.sales_before}'
  GROUP BY ALL)"""


def dense_cte() -> str:
    """Calendar as the reference writes it: keys x months, month >= first."""
    return f""",
fm AS (SELECT {KEYS}, min(sale_month) AS min_sale_month FROM ms GROUP BY ALL),
calendar AS (
  SELECT CAST(dt AS DATE) AS dt FROM (SELECT unnest(generate_series(
      TIMESTAMP '{P.calendar_start}', TIMESTAMP '{P.calendar_end}', INTERVAL 1 MONTH)) AS dt)),
grid AS (SELECT f.elc_master_id, f.consumer_id, f.brand_id, c.dt
         FROM fm f CROSS JOIN calendar c WHERE c.dt >= f.min_sale_month),
dense AS (
  SELECT g.dt, g.elc_master_id, g.consumer_id, g.brand_id, s.* EXCLUDE ({KEYS})
  FROM grid g LEFT JOIN ms s
    ON g.elc_master_id = s.elc_master_id AND g.consumer_id = s.consumer_id
   AND g.brand_id = s.brand_id AND g.dt = s.sale_month)"""


def _frame(lo: str, hi: str) -> str:
    return (f"OVER (PARTITION BY {KEYS} ORDER BY dt ROWS BETWEEN {lo} AND {hi})")


RUN = _frame("UNBOUNDED PRECEDING", "CURRENT ROW")


def _trail(n: int) -> str:
    return _frame(f"{n - 1} PRECEDING", "CURRENT ROW")


def snapshot_select() -> str:
    cols = ["dt AS snapshot_dt", KEYS]
    for c in TARGET_CATEGORIES:
        p = category_prefix(c)
        cols.append(f"CASE WHEN sum({units(p + '_amount')}) "
                    f"{_frame('1 FOLLOWING', '3 FOLLOWING')} > 0 THEN 1 ELSE 0 END "
                    f"AS target_{p}")
    cols += [
        f"min(sale_month) {RUN} AS first_purchase_dt",
        f"max(sale_month) {RUN} AS last_purchase_dt",
        f"{from_units('sum(' + units('sales_amount') + ') ' + RUN)} AS sales_tot",
        f"CAST(sum(txn_cnt) {RUN} AS DOUBLE) AS txn_cnt_tot",
        f"CAST(sum(CASE WHEN sales_amount > 0 THEN 1 ELSE 0 END) {_trail(12)} AS DOUBLE) AS sales_mnt_cnt_12m",
        f"{_ratio('sum(CASE WHEN item_cnt > 0 THEN item_cnt END) ' + RUN, 'count(CASE WHEN item_cnt > 0 THEN item_cnt END) ' + RUN)} AS avg_item_cnt",
    ]
    for c in CATEGORIES:
        p = category_prefix(c)
        cols.append(f"{p}_amount AS {p}_amt_last")
    cols += ["CAST(item_cnt AS DOUBLE) AS item_cnt_last",
             "CAST(txn_cnt AS DOUBLE) AS txn_cnt_last",
             "sales_amount AS sales_amt_last"]
    for c in FEATURE_CATEGORIES:
        p = category_prefix(c)
        a = f"{p}_amount"
        flag = f"CASE WHEN {a} > 0 THEN 1 ELSE 0 END"
        pos = f"CASE WHEN {a} > 0 THEN {a} END"
        pc = units(pos)
        for n in TRAILING_MONTHS:
            cols.append(f"CAST(sum({flag}) {_trail(n)} AS DOUBLE) AS {p}_cnt_{n}m")
        cols.append(f"{_ratio(from_units('sum(' + pc + ') ' + _trail(12)), 'count(' + pc + ') ' + _trail(12))} AS {p}_avg_12m")
        cols += [
            f"{from_units('sum(' + units(a) + ') ' + RUN)} AS {p}_amt_tot",
            f"CAST(sum({flag}) {RUN} AS DOUBLE) AS {p}_cnt_tot",
            f"min({pos}) {RUN} AS {p}_min",
            f"max({pos}) {RUN} AS {p}_max",
            f"{_ratio(from_units('sum(' + pc + ') ' + RUN), 'count(' + pc + ') ' + RUN)} AS {p}_avg",
        ]
    return ",\n  ".join(cols)


def snapshot_cte() -> str:
    return f""",
snap0 AS (SELECT {snapshot_select()} FROM dense),
snap AS (
  SELECT *, CAST(date_diff('month', first_purchase_dt, snapshot_dt) AS DOUBLE) AS months_since_first_purchase,
         CAST(date_diff('month', last_purchase_dt, snapshot_dt) AS DOUBLE) AS months_since_last_purchase
  FROM snap0)"""


def with_snapshot(select: str) -> str:
    return ("WITH " + sales_ctes() + monthly_cte() + dense_cte() + snapshot_cte()
            + "\n" + select)


def with_monthly(select: str) -> str:
    return "WITH " + sales_ctes() + monthly_cte() + "\n" + select


def with_dense(select: str) -> str:
    return "WITH " + sales_ctes() + monthly_cte() + dense_cte() + "\n" + select


def with_sales(select: str) -> str:
    return "WITH " + sales_ctes() + "\n" + select


def people_ctes() -> str:
    """Consumer variables, consumer attributes and store dimension (mirror of
    spendgrid.sources.testdata)."""
    n = "CAST(NULL AS VARCHAR)"
    flag = lambda cond: f"CASE WHEN {cond} THEN '1' ELSE '0' END"
    return f""",
src_cv AS (
  SELECT c_name AS elc_master_id, {n} AS ethnic_group, {n} AS gender, {n} AS language,
         {n} AS marital_status, {n} AS occupation_group, c_mktsegment AS mosaic_segment,
         {n} AS mosaic_group, {n} AS age_range, {n} AS ethnicity_detail,
         c_mktsegment AS income, 1950 + c_nationkey AS birth_year, 'noam' AS cdp_region,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'D' ELSE 'U' END AS CDC_CODE
  FROM customer),
src_ca AS (
  SELECT c_name AS elc_master_id, c_custkey AS consumer_id, 'US' AS country_cd,
         'S' || CAST(c_nationkey AS VARCHAR) AS state_cd, 'en' AS lang_cd,
         {flag('c_acctbal > 0')} AS email_opt_in_ind,
         {flag('c_acctbal > 5000')} AS phone_opt_in_ind,
         {n} AS city, {n} AS zip_code,
         {flag("c_mktsegment = 'AUTOMOBILE'")} AS dm_opt_in_ind,
         {flag('c_acctbal > 2500')} AS mobile_contactable_ind,
         CAST(c_nationkey AS VARCHAR) AS first_store_id,
         CAST(c_nationkey AS VARCHAR) AS last_store_id,
         CAST(c_nationkey AS VARCHAR) AS closest_store,
         CAST(c_nationkey AS VARCHAR) AS most_frequent_store,
         c_mktsegment AS first_channel, 'N' AS deceased_flag, 'N' AS prison_flag,
         {flag('c_acctbal > 7500')} AS mobile_opt_in_ind,
         {n} AS dm_state, {n} AS dm_country,
         CASE WHEN c_nationkey >= 20 THEN 'emea' ELSE 'noam' END AS cdp_region
  FROM customer),
src_store AS (
  SELECT s.s_suppkey AS store_id, 'RETAIL' AS store_channel,
         CAST(s.s_nationkey AS VARCHAR) AS store_market_cd, s.s_name AS store_name,
         upper(substr(r.r_name, 1, 2)) AS store_brand_cd, r.r_name AS store_region,
         n.n_name AS store_sub_region, {n} AS store_state_prov_cd, {n} AS store_city,
         {n} AS store_postal_cd, CAST(NULL AS DOUBLE) AS store_latitude,
         CAST(NULL AS DOUBLE) AS store_longitude, 'A' AS store_status_cd
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def ratio_cte() -> str:
    """Behaviour ratios over the snapshot grid (needs dense_cte's grid)."""
    chans = {"fss": "FSS", "mobile": "MOBILE", "web": "WEB", "tablet": "TABLET"}
    flags = ",\n         ".join(
        f"max(CASE WHEN channel_cd = '{v}' THEN 1 ELSE 0 END) AS f_{k}" for k, v in chans.items())
    sums = ", ".join(f"sum(f_{k}) AS f_{k}" for k in chans)
    ratios = ",\n         ".join(
        f"{_ratio('sum(r.f_' + k + ') ' + _RUNR, 'sum(r.n_txn) ' + _RUNR)} AS {k}_txn_ratio"
        for k in chans)
    return f""",
txn_flags AS (
  SELECT {KEYS}, CAST(date_trunc('month', sale_dt) AS DATE) AS sale_month, txn_id,
         {flags},
         max(CASE WHEN loyalty_trans_flag = 'Y' THEN 1 ELSE 0 END) AS f_loyal,
         max(CASE WHEN src_txn_cd_desc = 'RETURN' THEN 1 ELSE 0 END) AS f_ret,
         sum({units('sales_amount')}) AS c_sales,
         sum({units('usd_discount_amount')}) AS c_disc,
         sum(CASE WHEN quarter(sale_dt) = 4 THEN {units('sales_amount')} ELSE 0 END) AS c_q4
  FROM sd WHERE sale_dt < DATE '{P.sales_before}' GROUP BY ALL),
ratio_month AS (
  SELECT {KEYS}, sale_month, count(*) AS n_txn, {sums}, sum(f_loyal) AS f_loyal,
         sum(f_ret) AS f_ret, sum(c_sales) AS c_sales, sum(c_disc) AS c_disc, sum(c_q4) AS c_q4
  FROM txn_flags GROUP BY ALL),
ratios AS (
  SELECT g.dt AS snapshot_dt, g.elc_master_id, g.consumer_id, g.brand_id,
         {ratios},
         {_ratio('sum(r.c_disc) ' + _RUNR, 'sum(r.c_sales) ' + _RUNR)} AS discount_ratio,
         {_ratio('sum(r.c_q4) ' + _RUNR, 'sum(r.c_sales) ' + _RUNR)} AS sales_q4_ratio,
         {_ratio('sum(r.f_loyal) ' + _RUNR, 'sum(r.n_txn) ' + _RUNR)} AS loyalty_txn_ratio,
         {_ratio('sum(r.f_ret) ' + _RUNR, 'sum(r.n_txn) ' + _RUNR)} AS return_txn_ratio
  FROM grid g LEFT JOIN ratio_month r
    ON g.elc_master_id = r.elc_master_id AND g.consumer_id = r.consumer_id
   AND g.brand_id = r.brand_id AND g.dt = r.sale_month)"""


_RUNR = ("OVER (PARTITION BY g.elc_master_id, g.consumer_id, g.brand_id ORDER BY g.dt "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")

STORE_COLS = ("store_channel, store_market_cd, store_name, store_brand_cd, store_region, "
              "store_sub_region, store_state_prov_cd, store_city, store_postal_cd, "
              "store_latitude, store_longitude, store_status_cd")


def store_cte() -> str:
    """Most frequent store by brute force: every grid month against every
    earlier visit of the key (fine at test scale)."""
    return f""",
visits AS (
  SELECT {KEYS}, store_id, CAST(date_trunc('month', sale_dt) AS DATE) AS sale_month,
         count(DISTINCT txn_id) AS n
  FROM sd WHERE sale_dt < DATE '{P.sales_before}' AND store_id IS NOT NULL GROUP BY ALL),
upto AS (
  SELECT g.dt, g.elc_master_id, g.consumer_id, g.brand_id, v.store_id, sum(v.n) AS n
  FROM grid g JOIN visits v
    ON g.elc_master_id = v.elc_master_id AND g.consumer_id = v.consumer_id
   AND g.brand_id = v.brand_id AND v.sale_month <= g.dt
  GROUP BY ALL),
leader AS (
  SELECT dt, {KEYS}, arg_max(store_id, n * 1000000000 - store_id) AS most_freq_store_id
  FROM upto GROUP BY ALL),
stores AS (
  SELECT g.dt AS snapshot_dt, g.elc_master_id, g.consumer_id, g.brand_id,
         l.most_freq_store_id, {STORE_COLS}
  FROM grid g
  LEFT JOIN leader l ON g.elc_master_id = l.elc_master_id AND g.consumer_id = l.consumer_id
   AND g.brand_id = l.brand_id AND g.dt = l.dt
  LEFT JOIN src_store s ON l.most_freq_store_id = s.store_id)"""


def master_select() -> str:
    cv = ("ethnic_group, gender, language, marital_status, occupation_group, "
          "mosaic_segment, mosaic_group, age_range, ethnicity_detail, income")
    ints = ("email_opt_in_ind", "phone_opt_in_ind", "dm_opt_in_ind",
            "mobile_contactable_ind", "first_store_id", "last_store_id",
            "closest_store", "most_frequent_store", "mobile_opt_in_ind")
    ca_order = ("country_cd", "state_cd", "lang_cd", "email_opt_in_ind",
                "phone_opt_in_ind", "city", "zip_code", "dm_opt_in_ind",
                "mobile_contactable_ind", "first_store_id", "last_store_id",
                "closest_store", "most_frequent_store", "first_channel",
                "deceased_flag", "prison_flag", "mobile_opt_in_ind", "dm_state",
                "dm_country")
    ca = ", ".join(f"TRY_CAST(ca.{c} AS INTEGER) AS {c}" if c in ints else f"ca.{c}"
                   for c in ca_order)
    ratios = ", ".join(f"cac.{c}" for c in (
        "fss_txn_ratio", "mobile_txn_ratio", "web_txn_ratio", "tablet_txn_ratio",
        "discount_ratio", "sales_q4_ratio", "loyalty_txn_ratio", "return_txn_ratio"))
    store = ", ".join(f"cas.{c.strip()}" for c in ("most_freq_store_id, " + STORE_COLS).split(","))
    return f"""
SELECT d.*, {', '.join('cv.' + c.strip() for c in cv.split(','))},
       CAST(year(d.snapshot_dt) - cv.birth_year AS INTEGER) AS age,
       CASE WHEN ca.consumer_id IS NOT NULL THEN 'Y' ELSE 'N' END AS exists_in_cdp,
       {ca}, {ratios}, {store}
FROM snap d
LEFT JOIN src_cv cv ON d.elc_master_id = cv.elc_master_id AND cv.cdp_region = 'noam'
      AND cv.CDC_CODE <> 'D'
LEFT JOIN src_ca ca ON d.elc_master_id = ca.elc_master_id AND d.consumer_id = ca.consumer_id
      AND ca.cdp_region = 'noam'
LEFT JOIN ratios cac ON d.consumer_id = cac.consumer_id AND d.elc_master_id = cac.elc_master_id
      AND d.brand_id = cac.brand_id AND d.snapshot_dt = cac.snapshot_dt
LEFT JOIN stores cas ON d.consumer_id = cas.consumer_id AND d.elc_master_id = cas.elc_master_id
      AND d.brand_id = cas.brand_id AND d.snapshot_dt = cas.snapshot_dt"""


def with_everything(select: str) -> str:
    return ("WITH " + sales_ctes() + people_ctes() + monthly_cte() + dense_cte()
            + snapshot_cte() + ratio_cte() + store_cte() + "\n" + select)


def token_ctes() -> str:
    return f""",
tok AS (
  SELECT DISTINCT sku_six_digit_identifier,
         lower(regexp_replace(regexp_replace(
             major_category_name || '_' || category_name || '_' || sub_category_name,
             '[&,/ ()-]', '_', 'g'), '_+', '_', 'g')) AS pdt_clean
  FROM src_product
  WHERE major_category_name IS NOT NULL AND product_type_code = 'FERT'),
emb AS (
  SELECT d.sale_dt, d.txn_id, d.elc_master_id, d.consumer_id, c.pdt_clean,
         d.sale_line_num, d.net_item_qty, d.usd_total_price AS sales_amount, d.product_sku,
         d.product_desc
  FROM vd d
  JOIN vh h ON d.txn_id = h.txn_id
  JOIN tok c ON substr(d.product_sku, 1, 6) = c.sku_six_digit_identifier
  JOIN bl b ON d.brand_id = b.brand_id)"""


def with_tokens(select: str) -> str:
    return "WITH " + sales_ctes() + token_ctes() + "\n" + select


def snapshot_names() -> list[str]:
    """Output column names of the snapshot, in order."""
    names = ["snapshot_dt", "elc_master_id", "consumer_id", "brand_id"]
    names += [f"target_{category_prefix(c)}" for c in TARGET_CATEGORIES]
    names += ["first_purchase_dt", "last_purchase_dt", "sales_tot", "txn_cnt_tot",
              "sales_mnt_cnt_12m", "avg_item_cnt"]
    names += [f"{category_prefix(c)}_amt_last" for c in CATEGORIES]
    names += ["item_cnt_last", "txn_cnt_last", "sales_amt_last"]
    for c in FEATURE_CATEGORIES:
        p = category_prefix(c)
        names += [f"{p}_cnt_{n}m" for n in TRAILING_MONTHS]
        names += [f"{p}_avg_12m", f"{p}_amt_tot", f"{p}_cnt_tot", f"{p}_min",
                  f"{p}_max", f"{p}_avg"]
    return names + ["months_since_first_purchase", "months_since_last_purchase"]


MASTER_TEXT = ("elc_master_id", "ethnic_group", "gender", "language", "marital_status",
               "occupation_group", "mosaic_segment", "mosaic_group", "age_range",
               "ethnicity_detail", "income", "exists_in_cdp", "country_cd", "state_cd",
               "lang_cd", "city", "zip_code", "first_channel", "deceased_flag",
               "prison_flag", "dm_state", "dm_country", "store_channel",
               "store_market_cd", "store_name", "store_brand_cd", "store_region",
               "store_sub_region", "store_state_prov_cd", "store_city",
               "store_postal_cd", "store_status_cd")


def master_names() -> list[str]:
    from spendgrid.operators import attributes as A
    ca = A.CA_COLUMNS
    return (snapshot_names() + list(A.CV_COLUMNS) + ["age", "exists_in_cdp"] + list(ca)
            + list(A.RATIO_COLUMNS) + ["most_freq_store_id"] + list(A.STORE_COLUMNS))


def model_matrix_select(target: str, source: str) -> str:
    from spendgrid.operators.matrix import DROP_COLUMNS, INDICATOR_COLUMNS
    cols = [c for c in master_names() if c not in DROP_COLUMNS]
    out = []
    for c in cols:
        if c in INDICATOR_COLUMNS:
            out.append(f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}")
        elif c in MASTER_TEXT:
            out.append(f"coalesce({c}, 'Unknown') AS {c}")
        else:
            out.append(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}")
    out.append(f"CAST(target_{target} AS INTEGER) AS label")
    return f"SELECT {', '.join(out)} FROM {source}"


SCORED = """, scored AS (
  SELECT l.doc_id AS id, l.quality AS label,
         CAST(d.n_chars AS DOUBLE) / (CAST(1000 AS DOUBLE) + CAST(d.n_chars AS DOUBLE)) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
by_score AS (
  SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
  FROM scored GROUP BY score),
cum AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
  FROM by_score),
tot AS (SELECT CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS n,
               count(*) AS rows FROM scored)"""


def metric_sql(expr: str, name: str, source: str = "cum") -> str:
    return f"WITH _x AS (SELECT 1){SCORED}\nSELECT round({expr}, 6) AS {name} FROM {source}, tot"


def metrics_oracle() -> dict[str, str]:
    ap = metric_sql("sum(pos * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / max(p)",
                    "avg_precision")
    auc = metric_sql("sum(pos * ((max(n) OVER () - fp) + neg / 2.0)) / max(p * n)", "roc_auc")
    auc = metric_sql("sum(pos * ((n - fp) + neg / 2.0)) / max(p * n)", "roc_auc")
    ks = metric_sql("max(abs((n - fp + neg) / n - (p - tp + pos) / p))", "ks_score")
    brier = metric_sql("avg((score - label) * (score - label))", "brier_score", "scored")
    cov = (f"WITH _x AS (SELECT 1){SCORED},\n"
           "ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rk FROM scored)\n"
           "SELECT round(CAST(sum(CASE WHEN rk <= (rows // 10) * 3 THEN label ELSE 0 END) AS DOUBLE)"
           " / max(p), 6) AS cov_at_decile_3 FROM ranked, tot")
    return {"avg_precision": ap, "roc_auc": auc, "ks_score": ks, "brier": brier,
            "coverage_at_decile": cov}

"""DuckDB SQL for the registered queries, written on the raw tables.

The SQL states each rule directly (fan-out joins, OR joins, unpartitioned windows),
as an independent check of the rewritten Spark plans.  Common table expressions are
kept by name and only those a query needs are emitted.
"""

from __future__ import annotations

import re

from patronage.functions import labels

START, AS_OF, EARLIER = "1995-01-01", "2001-08-01", "2001-06-30"
PARTNER_CHURN_START = "1996-01-01"

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def half_up(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,9)), {places}) AS DOUBLE)"


def to_long(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(24,6))) AS BIGINT)"


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def upto(value: str, steps, last: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} <= {bound} THEN '{name}'" for bound, name in steps) + f" ELSE '{last}' END"


def above(value: str, cuts) -> str:
    return "CASE " + " ".join(f"WHEN {value} > {cut} THEN '{name}'" for cut, name in cuts) + f" ELSE '{labels.GRADE_LOWEST}' END"


def build(select: str) -> str:
    """Prefix a SELECT with the CTEs it needs, in definition order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        for word in set(re.findall(r"\b[a-z][a-z0-9_]*\b", todo.pop())):
            if word in CTES and word not in needed:
                needed.add(word)
                todo.append(CTES[word])
    if not needed:
        return select
    parts = [f"{n} AS (\n{CTES[n]}\n)" for n in CTES if n in needed]
    return "WITH " + ",\n".join(parts) + "\n" + select


def oracle(name: str, select: str) -> None:
    ORACLES[name] = build(select)


# --- source tables --------------------------------------------------------------

CTES["src_events"] = """
SELECT CAST(o_orderdate AS DATE) AS event_dt, o_orderdate AS event_dttm, CAST(o_custkey AS VARCHAR) AS user_id,
  'D' || l_suppkey AS airbridge_device_id, CASE WHEN l_linestatus = 'O' THEN 'iOS' ELSE 'Android' END AS platform,
  CAST(o_orderkey AS VARCHAR) AS transaction_id,
  CASE WHEN l_returnflag = 'R' THEN 'Order Cancel (App)' ELSE 'Order Complete (App)' END AS event_category,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN '쇼핑' ELSE l_linestatus END AS event_label,
  CASE WHEN o_orderpriority = '5-LOW' AND l_linestatus = 'F' THEN '^PAY' WHEN o_orderpriority = '5-LOW' THEN 'other'
    WHEN o_orderpriority = '1-URGENT' THEN 'balso1sa1' WHEN o_orderpriority = '2-HIGH' THEN 'balso1sr2'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'balso2sa1' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'balso2sr1' END AS event_action,
  'item ' || l_partkey AS name, l_extendedprice AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["src_partner_orders"] = """
SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS subparam, 'item ' || l_partkey AS productname,
  l_extendedprice * l_discount AS commission
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'"""

CTES["src_partner_cancels"] = """
SELECT strftime(l_shipdate, '%Y%m%d') AS date, CAST(o_orderdate AS DATE) AS orderdate, CAST(o_custkey AS VARCHAR) AS subparam,
  -l_extendedprice * l_discount AS commission
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""

CTES["src_keywords"] = """
SELECT 'item ' || p_partkey AS name,
  CASE WHEN p_size = 1 THEN 'None' WHEN p_size = 2 THEN ' ' WHEN p_size = 3 THEN NULL WHEN p_type = 'PROMO' THEN 'PROMO/SALE' ELSE p_type END AS category1,
  CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN '' ELSE p_brand END AS category2
FROM part"""

CTES["src_app_members"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS platform, CAST(DATE '1995-01-01' + c_nationkey * 30 AS DATE) AS join_dt,
  CAST(floor(abs(c_acctbal) * 10) AS BIGINT) AS total_accumulate_cash, CAST(floor(c_acctbal) AS BIGINT) AS current_cash,
  CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS terms_agree_yn
FROM customer"""

CTES["src_mall_orders"] = """
SELECT CAST(o_orderdate AS DATE) AS order_dt, o_orderkey AS order_no, o_custkey AS member_no, l_partkey AS category_no,
  o_totalprice AS first_pay_amt, CASE WHEN l_orderkey IS NOT NULL THEN l_discount * 100 END AS commission_rate,
  CASE WHEN l_orderkey IS NULL THEN NULL WHEN o_orderstatus = 'F' THEN 'BUY_CONFIRM' WHEN o_orderstatus = 'O' THEN 'DELIVERY_ING'
    WHEN l_returnflag = 'R' THEN 'RETURN_DONE' WHEN l_returnflag = 'A' THEN 'CANCEL DONE' ELSE 'PAY_WAIT' END AS order_status_type
FROM orders LEFT JOIN (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_discount, l_returnflag, l_linestatus) = 1
) ON o_orderkey = l_orderkey"""

CTES["src_mall_members"] = """
SELECT c_custkey AS member_no, CASE WHEN c_nationkey <> 13 THEN CAST(c_custkey AS VARCHAR) END AS wk_id,
  CASE WHEN n_regionkey IN (0, 2) THEN 'F' WHEN n_regionkey IN (1, 3) THEN 'M' END AS gender,
  CASE WHEN c_nationkey = 7 THEN 'unknown' ELSE CAST(1950 + c_custkey % 50 AS VARCHAR) END AS birth_year
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

CTES["src_mall_categories"] = """
SELECT ascii(p_type) * 100 + length(p_type) AS depth1_category_no, CASE WHEN p_type = 'PROMO' THEN 'PROMO/SALE' ELSE p_type END AS depth1_category_name,
  CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN '' ELSE p_brand END AS depth2_category_name,
  p_partkey + 1 AS depth3_category_no, p_partkey AS depth4_category_no
FROM part"""

CTES["src_ledger"] = """
SELECT user_id AS member_no, CAST(floor(value) AS BIGINT) AS amt,
  CASE event_type WHEN 'purchase' THEN '지급' WHEN 'click' THEN '취소로 인한 지급' WHEN 'error' THEN '차감' ELSE event_type END AS accumulation_status,
  ts - INTERVAL 24 YEAR AS register_dttm
FROM events"""

CTES["src_wall"] = """
SELECT CAST(user_id AS VARCHAR) AS user_id, date_diff('day', max(CAST(ts AS DATE)), DATE '2024-01-31') AS recency,
  count(DISTINCT CAST(ts AS DATE)) AS frequency, round(sum(value), 2) AS monetary
FROM events GROUP BY 1"""


# --- affiliate revenue -------------------------------------------------------------

_GRAIN = "event_dt, event_dttm, user_id, airbridge_device_id, transaction_id, platform, event_category, event_label, event_action"
_ENTRY = "CASE event_action " + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in labels.ENTRY_LABELS.items()) + " END"


def _rollup(window: str, category: str, sign: int, by_name: bool = False) -> str:
    name = ", name" if by_name else ""
    return f"""
SELECT event_dt, user_id, transaction_id, entry AS event_label, event_action, min(airbridge_device_id) AS airbridge_device_id,
  min(platform) AS platform, {"min(name) AS name," if by_name else ""} min(event_category) AS event_category, sum(revenue) AS revenue
FROM (
  SELECT {_GRAIN}{name}, {_ENTRY} AS entry, round(sum(price) * {labels.COMMISSION_SHARE}) * {sign} AS revenue
  FROM {window} WHERE event_category = '{category}' GROUP BY {_GRAIN}{name}
) GROUP BY event_dt, user_id, transaction_id, entry, event_action"""


def _floor(x: str, floor: bool) -> str:
    return f"CASE WHEN {x} < 0 THEN 0 ELSE {x} END" if floor else x


def affiliate_ctes(p: str, start: str, as_of: str, partner_start: str, floor: bool) -> None:
    CTES[f"{p}_win"] = f"""
SELECT * FROM src_events WHERE event_dt BETWEEN DATE '{start}' AND DATE '{as_of}' AND event_action NOT LIKE '^PAY'
  AND event_label <> '쇼핑' AND user_id NOT LIKE 'IU_%' AND user_id IS NOT NULL"""
    CTES[f"{p}_order"] = _rollup(f"{p}_win", "Order Complete (App)", 1)
    CTES[f"{p}_order_named"] = _rollup(f"{p}_win", "Order Complete (App)", 1, by_name=True)
    CTES[f"{p}_refund"] = _rollup(f"{p}_win", "Order Cancel (App)", -1)
    net = _floor("(o.revenue + coalesce(r.revenue, 0))", floor)
    CTES[f"{p}_net"] = f"""
SELECT o.* EXCLUDE (revenue), {net} AS revenue
FROM {p}_order o LEFT JOIN {p}_refund r ON o.user_id = r.user_id AND o.transaction_id = r.transaction_id"""
    CTES[f"{p}_net_named"] = f"""
SELECT o.* EXCLUDE (revenue), {net} AS revenue
FROM {p}_order_named o LEFT JOIN {p}_refund r ON o.user_id = r.user_id AND o.transaction_id = r.transaction_id"""
    CTES[f"{p}_pday"] = f"""
SELECT date AS event_dt, subparam AS user_id, min(productname) AS name, sum(commission) AS revenue,
  'Order Complete (App)' AS event_category, 'dynamic' AS event_action, 'coin' AS event_label
FROM src_partner_orders WHERE date BETWEEN DATE '{partner_start}' AND DATE '{as_of}' AND subparam IS NOT NULL GROUP BY 1, 2"""
    CTES[f"{p}_pcan"] = f"""
SELECT CAST(strptime(date, '%Y%m%d') AS DATE) AS event_dt, orderdate AS order_date, subparam AS user_id, sum(commission) AS revenue
FROM src_partner_cancels
WHERE CAST(strptime(date, '%Y%m%d') AS DATE) BETWEEN DATE '{partner_start}' AND DATE '{as_of}' AND subparam IS NOT NULL GROUP BY 1, 2, 3"""
    CTES[f"{p}_netp"] = f"""
SELECT o.* EXCLUDE (revenue), {net} AS revenue
FROM {p}_pday o LEFT JOIN {p}_pcan r ON o.user_id = r.user_id AND o.event_dt = r.order_date"""
    CTES[f"{p}_all"] = f"""
SELECT event_dt, user_id, event_category, event_label, revenue FROM {p}_net
UNION ALL SELECT event_dt, user_id, event_category, event_label, revenue FROM {p}_netp"""
    CTES[f"{p}_all_named"] = f"""
SELECT event_dt, user_id, name, revenue FROM {p}_net_named UNION ALL SELECT event_dt, user_id, name, revenue FROM {p}_netp"""


def activity_cte(p: str, purchases: str, as_of: str) -> None:
    CTES[f"{p}_activity"] = f"""
SELECT up.user_id, up.platform, up.join_dt, date_diff('day', up.join_dt, DATE '{as_of}') AS cum_lifetime,
  max(up.total_accumulate_cash) AS total_accumulate_cash, max(up.current_cash) AS current_cash,
  date_diff('day', max(cc.event_dt), DATE '{as_of}') AS recency, count(DISTINCT cc.event_dt) AS frequency,
  sum(coalesce(cc.revenue, 0)) AS monetary, DATE '{as_of}' AS snapshot_dt
FROM src_app_members up LEFT JOIN {purchases} cc ON up.user_id = cc.user_id
WHERE cc.event_dt IS NULL OR cc.event_dt <= DATE '{as_of}' GROUP BY up.user_id, up.platform, up.join_dt"""


# --- mall RFM --------------------------------------------------------------------


def mall_rfm_ctes(p: str, as_of: str, known: str = "TRUE") -> None:
    """known: which refunds the date knows of."""
    CTES[f"{p}_valid"] = f"""
SELECT o.order_no, o.order_dt, o.member_no, m.wk_id AS user_id, a.join_dt, a.total_accumulate_cash, a.current_cash, a.platform,
  m.gender, m.birth_year, o.commission_rate, o.first_pay_amt, o.order_status_type
FROM src_mall_orders o LEFT JOIN src_mall_members m ON o.member_no = m.member_no LEFT JOIN src_app_members a ON m.wk_id = a.user_id
WHERE o.order_status_type IN ({listed(labels.MALL_VALID_STATUSES)})
  AND o.order_dt BETWEEN DATE '{START}' AND DATE '{as_of}'"""
    CTES[f"{p}_checked"] = f"""
SELECT v.*, r.order_no AS refund_no,
  coalesce(r.order_dt <= least(v.order_dt + {labels.REFUND_WINDOW_DAYS}, DATE '{as_of}'), FALSE) AS is_refunded
FROM {p}_valid v LEFT JOIN (SELECT * FROM src_mall_orders WHERE {known} AND order_status_type IN ({listed(labels.MALL_REFUND_STATUSES)})) r
  ON v.member_no = r.member_no"""
    CTES[f"{p}_once"] = f"""
SELECT * EXCLUDE (is_refunded, refund_no), bool_or(is_refunded) AS is_refunded FROM {p}_checked GROUP BY ALL"""
    for name, rows in (("rfm", f"{p}_checked"), ("rfm_once", f"{p}_once")):
        CTES[f"{p}_{name}"] = f"""
SELECT member_no, user_id, max(platform) AS platform, max(join_dt) AS join_dt,
  date_diff('day', max(join_dt), DATE '{as_of}') AS cum_lifetime, max(total_accumulate_cash) AS total_accumulate_cash,
  max(current_cash) AS current_cash,
  date_diff('day', max(CASE WHEN NOT is_refunded THEN order_dt END), DATE '{as_of}') AS recency,
  count(DISTINCT CASE WHEN NOT is_refunded THEN order_dt END) AS frequency,
  sum(CASE WHEN NOT is_refunded THEN first_pay_amt ELSE 0 END) AS monetary,
  max(gender) AS gender, max(birth_year) AS birth_year, avg(commission_rate) AS avg_commission_rate, count(*) AS total_purchases,
  count(CASE WHEN is_refunded THEN 1 END) AS total_refunds,
  {half_up("count(CASE WHEN is_refunded THEN 1 END) * 100.0 / nullif(count(*), 0)", 2)} AS refund_rate,
  max(CASE WHEN NOT is_refunded THEN order_dt END) AS last_order_dt, min(order_dt) AS first_order_dt, DATE '{as_of}' AS snapshot_dt
FROM {rows} GROUP BY member_no, user_id"""


# --- categories -----------------------------------------------------------------------


def interest(stats: str, user: str, as_of: str) -> str:
    return f"""
SELECT {user}, label, score, {half_up(f"score / sum(score) OVER (PARTITION BY {user})", 2)} AS interest_ratio
FROM (SELECT {user}, label, 0.6 * (CAST(order_count AS DOUBLE) / sum(order_count) OVER (PARTITION BY {user}))
  + 0.4 * exp(-0.1 * abs(date_diff('day', latest_dt, DATE '{as_of}'))) AS score FROM {stats})"""


def ranked(shares: str, user: str, top: int) -> str:
    return f"""
SELECT {user}, label, interest_ratio, row_number() OVER (PARTITION BY {user} ORDER BY interest_ratio DESC NULLS LAST, label NULLS FIRST) AS ranking
FROM {shares} QUALIFY ranking <= {top}"""


def pivot(source: str, user: str, depth: int, top: int) -> str:
    cols = [
        f"max(CASE WHEN ranking = {i} THEN {c} END) AS {out}_{depth}_{i}"
        for c, out in (("label", "ranking"), ("interest_ratio", "power"))
        for i in range(1, top + 1)
    ]
    return f"SELECT {user}, {', '.join(cols)} FROM {source} GROUP BY {user}"


RANKING_COLUMNS = (
    [f"ranking_1_{i}" for i in range(1, 4)] + [f"power_1_{i}" for i in range(1, 4)]
    + [f"ranking_2_{i}" for i in range(1, 7)] + [f"power_2_{i}" for i in range(1, 7)]
)


def category_ctes(p: str, as_of: str) -> None:
    CTES[f"{p}_cat_raw"] = f"""
SELECT c.user_id, c.event_dt, k.category1, replace(k.category1, '/', '-') AS depth1, replace(k.category2, '/', '-') AS depth2
FROM {p}_all_named c LEFT JOIN src_keywords k ON k.name = c.name
WHERE k.category1 IS NOT NULL AND trim(k.category1) <> '' AND trim(k.category1) <> 'None'"""
    CTES[f"{p}_stat1"] = f"""
SELECT user_id, depth1 AS label, max(event_dt) AS latest_dt, count(DISTINCT event_dt) AS order_count FROM {p}_cat_raw GROUP BY 1, 2"""
    CTES[f"{p}_stat2"] = f"""
SELECT user_id, concat(depth1, '(', coalesce(nullif(trim(depth2), ''), '{labels.NO_SUBCATEGORY}'), ')') AS label, max(event_dt) AS latest_dt,
  count(DISTINCT event_dt) AS order_count FROM {p}_cat_raw GROUP BY user_id, depth1, depth2"""
    CTES[f"{p}_mcat_raw"] = f"""
SELECT o.order_dt, o.member_no, o.category_no, b.depth1_category_no, replace(b.depth1_category_name, '/', '-') AS depth1,
  replace(b.depth2_category_name, '/', '-') AS depth2
FROM src_mall_orders o LEFT JOIN src_mall_categories b ON b.depth4_category_no = o.category_no OR b.depth3_category_no = o.category_no
WHERE o.order_dt BETWEEN DATE '{START}' AND DATE '{as_of}'"""
    CTES[f"{p}_mstat1"] = f"""
SELECT member_no, depth1_category_no, max(depth1) AS label, max(order_dt) AS latest_dt, count(DISTINCT order_dt) AS order_count
FROM {p}_mcat_raw GROUP BY 1, 2"""
    CTES[f"{p}_mstat2"] = f"""
SELECT member_no, concat(depth1, '(', CASE WHEN depth2 IS NULL OR trim(depth2) = '' THEN '{labels.NO_SUBCATEGORY}' ELSE depth2 END, ')') AS label,
  max(order_dt) AS latest_dt, count(DISTINCT order_dt) AS order_count
FROM {p}_mcat_raw WHERE depth1 IS NOT NULL AND trim(depth1) <> '' AND trim(depth1) <> 'None' GROUP BY member_no, depth1, depth2"""
    for m, user in (("", "user_id"), ("m", "member_no")):
        for depth, top in ((1, 3), (2, 6)):
            CTES[f"{p}_{m}int{depth}"] = interest(f"{p}_{m}stat{depth}", user, as_of)
            CTES[f"{p}_{m}rank{depth}"] = ranked(f"{p}_{m}int{depth}", user, top)
            CTES[f"{p}_{m}piv{depth}"] = pivot(f"{p}_{m}rank{depth}", user, depth, top)
    CTES[f"{p}_power"] = f"SELECT a.*, b.* EXCLUDE (user_id) FROM {p}_piv1 a LEFT JOIN {p}_piv2 b ON a.user_id = b.user_id"
    CTES[f"{p}_mpower"] = f"""
SELECT m.wk_id AS user_id, a.* EXCLUDE (member_no), b.* EXCLUDE (member_no)
FROM {p}_mpiv1 a LEFT JOIN {p}_mpiv2 b ON a.member_no = b.member_no LEFT JOIN src_mall_members m ON a.member_no = m.member_no"""


# --- survival -------------------------------------------------------------------------------

_AGE = "CAST(CAST(floor((year({ref}) - TRY_CAST({b} AS BIGINT)) / 10) * 10 AS BIGINT) AS VARCHAR)"


def age(birth: str, ref: str) -> str:
    return _AGE.format(b=birth, ref=ref)


def least_or_null(x: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN greatest({x}, 0.0001) END"


def survival_ctes(s: str, days: str, as_of: str, grouped: bool) -> None:
    """s: prefix; days(user_id, order_dt[, member_no, gender, birth_year])."""
    ref = f"(DATE '{as_of}' + 1)"
    g = "gender, birth_year," if grouped else ""
    tie = ", member_no DESC NULLS LAST" if grouped else ""
    CTES[f"{s}_base_data"] = f"""
SELECT user_id, order_dt, {g}
  row_number() OVER (PARTITION BY user_id ORDER BY order_dt DESC{tie}) AS recency_rank,
  row_number() OVER (PARTITION BY user_id ORDER BY order_dt) AS purchase_rank
FROM {days}"""
    extra = f", gender, {age('birth_year', ref)} AS age_group" if grouped else ""
    CTES[f"{s}_recent"] = f"""
SELECT user_id, date_diff('day', order_dt, {ref}) AS days_since_last_purchase{extra} FROM {s}_base_data WHERE recency_rank = 1"""
    CTES[f"{s}_gaps"] = f"""
SELECT user_id, order_dt, purchase_rank, lead(order_dt) OVER (PARTITION BY user_id ORDER BY order_dt) AS next_order_date,
  date_diff('day', order_dt, lead(order_dt) OVER (PARTITION BY user_id ORDER BY order_dt)) AS days_between_orders
FROM {s}_base_data WHERE purchase_rank <= 15"""
    for kind, where in (("current", "purchase_rank BETWEEN 1 AND 3"), ("prev", "purchase_rank BETWEEN 2 AND 4")):
        CTES[f"{s}_{kind}"] = f"""
SELECT user_id, {half_up("avg(days_between_orders)", 1)} AS {kind}_trailing_term FROM {s}_gaps
WHERE days_between_orders IS NOT NULL AND {where} GROUP BY user_id"""
    CTES[f"{s}_spread"] = f"""
SELECT user_id, stddev_samp(days_between_orders) AS cycle_stddev FROM {s}_gaps WHERE days_between_orders IS NOT NULL GROUP BY user_id"""
    CTES[f"{s}_base"] = f"""
SELECT c.user_id, r.* EXCLUDE (user_id), c.current_trailing_term, p.prev_trailing_term, s.cycle_stddev,
  {half_up("(c.current_trailing_term - p.prev_trailing_term) / nullif(p.prev_trailing_term, 0) * 100", 1)} AS cycle_change_rate,
  round(s.cycle_stddev / nullif(c.current_trailing_term, 0) * 100, 1) AS cycle_variation_rate
FROM {s}_current c LEFT JOIN {s}_prev p ON c.user_id = p.user_id LEFT JOIN {s}_spread s ON c.user_id = s.user_id
LEFT JOIN {s}_recent r ON c.user_id = r.user_id"""
    CTES[f"{s}_tstats"] = f"""
SELECT stddev_samp(ln(current_trailing_term)) AS log_stddev, avg(ln(current_trailing_term)) AS log_mean,
  stddev_samp(current_trailing_term) AS pop_stddev, avg(current_trailing_term) AS pop_mean FROM {s}_base WHERE current_trailing_term > 0"""
    CTES[f"{s}_median"] = f"""
SELECT quantile_disc(current_trailing_term, 0.5) AS median_term, quantile_disc(ln(current_trailing_term), 0.5) AS log_median_term
FROM {s}_base WHERE current_trailing_term > 0"""
    CTES[f"{s}_mad"] = f"""
SELECT quantile_disc(abs(current_trailing_term - median_term), 0.5) AS mad,
  quantile_disc(abs(ln(current_trailing_term) - log_median_term), 0.5) AS log_mad
FROM {s}_base, {s}_median WHERE current_trailing_term > 0"""
    CTES[f"{s}_robust"] = f"""
SELECT b.user_id, b.current_trailing_term, t.pop_mean, b.days_since_last_purchase,
  0.6745 * (ln(b.current_trailing_term) - m.log_median_term) / nullif(d.log_mad, 0) AS modified_zscore
FROM {s}_base b, {s}_tstats t, {s}_median m, {s}_mad d WHERE b.current_trailing_term > 0"""
    keep = ", b.age_group, b.gender" if grouped else ""
    CTES[f"{s}_churn"] = f"""
SELECT r.user_id, r.current_trailing_term{keep},
  CAST(coalesce(r.days_since_last_purchase > 2 * if(coalesce(abs(r.modified_zscore), 0) > 3.5, r.pop_mean, r.current_trailing_term), FALSE) AS BIGINT) AS churn_flag
FROM {s}_robust r {f"LEFT JOIN {s}_base b ON r.user_id = b.user_id" if grouped else ""}"""
    by = "age_group, gender," if grouped else ""
    CTES[f"{s}_rates"] = f"""
SELECT {by} CAST(sum(churn_flag) AS DOUBLE) / count(*) AS avg_churn_rate, avg(current_trailing_term) AS avg_group_term,
  count(*) AS group_user_count FROM {s}_churn {"GROUP BY age_group, gender" if grouped else ""}"""
    gsel = ", b.gender" if grouped else ""
    CTES[f"{s}_weeks"] = f"""
SELECT CAST(floor(b.days_since_last_purchase / 7) * 7 AS BIGINT) AS time_point{gsel}, count(*) AS n_risk, CAST(sum(c.churn_flag) AS BIGINT) AS n_events
FROM {s}_base b LEFT JOIN {s}_churn c ON b.user_id = c.user_id GROUP BY ALL"""
    if grouped:
        CTES[f"{s}_buckets"] = f"""
SELECT f.time_point, f.gender,
  coalesce(w.n_risk, (lag(w.n_risk) OVER o + lead(w.n_risk) OVER o) / 2) AS n_risk,
  coalesce(w.n_events, (lag(w.n_events) OVER o + lead(w.n_events) OVER o) / 2) AS n_events
FROM (SELECT t.time_point, g.gender FROM (SELECT unnest(generate_series(0, (SELECT max(time_point) FROM {s}_weeks), 7)) AS time_point) t,
  (SELECT DISTINCT gender FROM {s}_base WHERE gender IS NOT NULL) g) f
LEFT JOIN {s}_weeks w ON f.time_point = w.time_point AND f.gender = w.gender
WINDOW o AS (PARTITION BY f.gender ORDER BY f.time_point)"""
        rate = f"(SELECT gender AS rate_gender, avg(avg_churn_rate) AS avg_churn_rate FROM {s}_rates GROUP BY gender)"
        source = f"{s}_buckets b LEFT JOIN {rate} a ON b.gender = a.rate_gender"
    else:
        CTES[f"{s}_buckets"] = f"SELECT * FROM {s}_weeks"
        source = f"{s}_buckets b, (SELECT avg_churn_rate FROM {s}_rates) a"
    step = "1 - CAST(b.n_events AS DOUBLE) / b.n_risk"
    safe = f"CASE WHEN b.n_risk > 0 THEN {step} ELSE 1 END"
    part = "PARTITION BY b.gender" if grouped else ""
    CTES[f"{s}_curve"] = f"""
SELECT b.time_point{gsel}, b.n_risk, b.n_events, {half_up(safe, 4)} AS base_survival_prob,
  {half_up(f"CASE WHEN b.n_risk > 0 THEN ({step}) * (1 - coalesce(a.avg_churn_rate, 0)) ELSE 1 END", 4)} AS weighted_survival_prob,
  {half_up(f"exp(sum(ln({least_or_null(safe)})) OVER ({part} ORDER BY b.time_point NULLS FIRST))", 4)} AS cumulative_survival_prob
FROM {source}"""
    glist = "gender," if grouped else ""
    CTES[f"{s}_least"] = f"""
SELECT {glist} min(cumulative_survival_prob) AS least FROM {s}_curve {"GROUP BY gender" if grouped else ""}"""
    week = "CAST(floor({}.days_since_last_purchase / 7) * 7 AS BIGINT)"
    if grouped:
        joins = f"""LEFT JOIN {s}_curve k ON k.gender = b.gender AND k.time_point = {week.format("b")}
  LEFT JOIN {s}_least m ON m.gender = b.gender"""
        rates = f"LEFT JOIN {s}_rates acr ON b.age_group = acr.age_group AND b.gender = acr.gender"
    else:
        joins = f"LEFT JOIN {s}_curve k ON k.time_point = {week.format('b')} CROSS JOIN {s}_least m"
        rates = f"CROSS JOIN {s}_rates acr"
    own = "exp(-r.days_since_last_purchase / CASE WHEN abs(r.modified_zscore) > 3.5 THEN r.pop_mean ELSE nullif(b.current_trailing_term, 0) END)"
    mixed = f"0.7 * {own} + 0.3 * coalesce(k.cumulative_survival_prob, m.least)"
    CTES[f"{s}_indiv"] = f"""
SELECT b.user_id{", b.age_group, b.gender" if grouped else ""}, b.days_since_last_purchase, b.current_trailing_term, c.churn_flag,
  r.modified_zscore, acr.avg_churn_rate, acr.avg_group_term,
  {f"CASE WHEN b.gender IS NULL THEN {own} ELSE {mixed} END" if grouped else mixed} AS survival_prob
FROM {s}_base b LEFT JOIN {s}_churn c ON b.user_id = c.user_id LEFT JOIN {s}_robust r ON b.user_id = r.user_id
  {rates} {joins}"""
    CTES[f"{s}_new"] = f"""
SELECT r.* FROM {s}_recent r WHERE NOT EXISTS (SELECT 1 FROM {s}_gaps p WHERE p.user_id = r.user_id AND p.purchase_rank > 1)"""
    risk = upto("survival_prob", labels.RISK_CLASSES, labels.RISK_NONE)
    new_own = "exp(-b.days_since_last_purchase / t.pop_mean)"
    new_mixed = f"0.7 * {new_own} + 0.3 * coalesce(k.cumulative_survival_prob, m.least)"
    gk = "age_group, gender," if grouped else ""
    left = "-t.pop_mean * ln(0.5) - b.days_since_last_purchase"
    # survival_prob of the repeat buyers is rounded for output only; the class uses the exact value.
    CTES[f"{s}_table"] = f"""
SELECT user_id, days_since_last_purchase, {gk} CAST(NULL AS DOUBLE) AS current_trailing_term, CAST(NULL AS DOUBLE) AS prev_trailing_term,
  CAST(NULL AS DOUBLE) AS cycle_stddev, CAST(NULL AS DOUBLE) AS modified_zscore, CAST(NULL AS DOUBLE) AS demographic_churn_rate,
  CAST(NULL AS BIGINT) AS churn_flag, survival_prob, predicted_survival_time, '{labels.CYCLE_NEW}' AS cycle_length, {risk} AS risk_level, {ref} AS cur
FROM (SELECT b.*, {f"CASE WHEN b.gender IS NOT NULL THEN {new_mixed} ELSE {new_own} END" if grouped else new_mixed} AS survival_prob,
    CASE WHEN ({left}) IS NOT NULL THEN greatest({left}, 0) END AS predicted_survival_time
  FROM {s}_new b CROSS JOIN {s}_tstats t {joins})
UNION ALL
SELECT b.user_id, b.days_since_last_purchase, {gk.replace("age_group", "b.age_group").replace(" gender", " b.gender")} b.current_trailing_term, b.prev_trailing_term, round(b.cycle_stddev), i.modified_zscore,
  i.avg_churn_rate, i.churn_flag, {half_up("i.survival_prob", 2)},
  CASE WHEN b.days_since_last_purchase IS NOT NULL THEN greatest(round(-(CASE WHEN abs(i.modified_zscore) > 3.5 THEN r.pop_mean ELSE b.current_trailing_term END) * ln(0.5) - b.days_since_last_purchase), 0) END,
  {upto("b.current_trailing_term", labels.CYCLE_CLASSES, labels.CYCLE_LONGEST)},
  {risk.replace("survival_prob", "i.survival_prob")}, {ref}
FROM {s}_base b LEFT JOIN {s}_indiv i ON b.user_id = i.user_id LEFT JOIN {s}_robust r ON b.user_id = r.user_id"""


# --- merged profile and scores ---------------------------------------------------------------

_SURVIVAL = {
    "days_since_last_purchase": "last_purchase", "current_trailing_term": "current_trailing_term",
    "prev_trailing_term": "prev_trailing_term", "cycle_stddev": "cycle_stddev", "survival_prob": "suvival_prob",
    "predicted_survival_time": "predicted_survival_time", "risk_level": "risk_level", "cycle_length": "cycle_length",
}


def merged_ctes(p: str, as_of: str) -> None:
    CTES[f"{p}_balance"] = f"""
SELECT b.wk_id AS user_id, CAST(sum(a.amt) FILTER (a.accumulation_status IN ({listed(labels.LEDGER_CREDITS)})) AS BIGINT) AS accumulate_shoji,
  CAST(coalesce(sum(a.amt) FILTER (a.accumulation_status IN ({listed(labels.LEDGER_CREDITS)}))
    - sum(a.amt) FILTER (a.accumulation_status IN ({listed(labels.LEDGER_DEBITS)})), 0) AS BIGINT) AS current_shoji
FROM src_ledger a LEFT JOIN src_mall_members b ON a.member_no = b.member_no WHERE CAST(a.register_dttm AS DATE) <= DATE '{as_of}' GROUP BY 1"""
    CTES[f"{p}_member"] = """
SELECT a.user_id, a.join_dt, a.platform, a.current_cash, a.total_accumulate_cash, a.terms_agree_yn, b.gender, b.birth_year
FROM src_app_members a LEFT JOIN src_mall_members b ON a.user_id = b.wk_id"""
    for track in ("affiliate", "mall"):
        mall = track == "mall"
        lead, other = (f"{p}_rfm", f"{p}_arfm") if mall else (f"{p}_arfm", f"{p}_rfm")
        m, a = ("l", "o") if mall else ("o", "l")
        CTES[f"{p}_joined_{track}"] = f"""
SELECT l.user_id, coalesce(l.platform, o.platform, mb.platform) AS platform, coalesce(l.join_dt, o.join_dt, mb.join_dt) AS join_dt,
  coalesce(l.cum_lifetime, o.cum_lifetime) AS cum_lifetime, coalesce({m}.gender, mb.gender) AS gender,
  coalesce({m}.birth_year, mb.birth_year) AS birth_year,
  coalesce(l.total_accumulate_cash, o.total_accumulate_cash, mb.total_accumulate_cash) AS total_accumulate_cash,
  {"l.first_order_dt, l.refund_rate," if mall else ""}
  {m}.recency AS r_s, {m}.frequency AS f_s, {m}.monetary AS m_s, {a}.recency AS r_b, {a}.frequency AS f_b, {a}.monetary AS m_b,
  n.recency AS r_n, n.frequency AS f_n, n.monetary AS m_n, mb.current_cash, mb.terms_agree_yn, c.accumulate_shoji, c.current_shoji,
  {", ".join(f"d.{k} AS {v}_shop" for k, v in _SURVIVAL.items())},
  {", ".join(f"e.{k} AS {v}_byshop" for k, v in _SURVIVAL.items())},
  {", ".join(f"f.{k} AS {k}_sp" for k in RANKING_COLUMNS)},
  {", ".join(f"g.{k} AS {k}_bs" for k in RANKING_COLUMNS)}
FROM (SELECT * FROM {lead} WHERE monetary >= 1) l LEFT JOIN {other} o ON l.user_id = o.user_id
LEFT JOIN src_wall n ON l.user_id = n.user_id LEFT JOIN {p}_member mb ON l.user_id = mb.user_id
LEFT JOIN {p}_balance c ON l.user_id = c.user_id LEFT JOIN {p}_sm_table d ON l.user_id = d.user_id
LEFT JOIN {p}_sa_table e ON l.user_id = e.user_id LEFT JOIN {p}_mpower f ON l.user_id = f.user_id LEFT JOIN {p}_power g ON l.user_id = g.user_id"""
        channels = (("shop", "s"), ("byshop", "b"), ("noncommerce", "n"))
        CTES[f"{p}_merged_{track}"] = f"""
SELECT CASE WHEN f_shop > 0 THEN 'shopping' ELSE 'non-shopping' END AS tgt, *, DATE '{as_of}' AS snapshot_dt FROM (
SELECT user_id, max(platform) AS platform, max(join_dt) AS join_dt, max(cum_lifetime) AS cum_lifetime, max(gender) AS gender,
  max(birth_year) AS birth_year, {"max(first_order_dt) AS first_order_dt, max(refund_rate) AS refund_rate," if mall else ""}
  max(terms_agree_yn) AS terms_agree_yn, max(coalesce(total_accumulate_cash, 0)) AS total_accumulate_cash,
  max(coalesce(accumulate_shoji, 0)) AS total_accumulate_shoji, max(coalesce(current_cash, 0)) AS current_cash,
  max(coalesce(current_shoji, 0)) AS current_shoji,
  {", ".join(f"max({v}_{s}) AS {v}_{s}" for s in ("shop", "byshop") for v in _SURVIVAL.values())},
  {", ".join(f"coalesce(min(r_{c}), 99999) AS r_{s}, max(coalesce({to_long(f'f_{c}')}, 0)) AS f_{s}, max(coalesce({to_long(f'm_{c}')}, 0)) AS m_{s}" for s, c in channels)},
  coalesce(max(m_n), 0) + coalesce(max(m_s), 0) + coalesce(max(m_b), 0) AS m_total,
  coalesce(max(f_n), 0) + coalesce(max(f_s), 0) + coalesce(max(f_b), 0) AS f_total,
  {", ".join(f"max({k}_{s}) AS {k}_{s}" for s in ("sp", "bs") for k in RANKING_COLUMNS)}
FROM {p}_joined_{track} GROUP BY user_id)"""
        sfx, cat = ("shop", "sp") if mall else ("byshop", "bs")
        term, prev = f"current_trailing_term_{sfx}", f"prev_trailing_term_{sfx}"

        # One tiling per score over the rows it covers, joined back; uncovered rows score 1.
        tilings = {
            "r_score": (10, 0, f"r_{sfx} DESC NULLS LAST", "TRUE"),
            "f_score": (9, 1, f"f_{sfx}", f"f_{sfx} > 1"),
            "m_score": (10, 0, f"m_{sfx}", "TRUE"),
            "term_score": (9, 1, f"{term} DESC", f"{term} IS NOT NULL"),
            "term_diff_score": (9, 1, f"({term} - {prev}) DESC", f"{prev} IS NOT NULL"),
            "volatility_score": (9, 1, f"cycle_stddev_{sfx} DESC NULLS LAST", f"{term} IS NOT NULL"),
        }
        for score, (k, shift, key, covered) in tilings.items():
            CTES[f"{p}_{score}_{track}"] = f"""
SELECT user_id, ntile({k}) OVER (ORDER BY {key}, user_id NULLS FIRST) + {shift} AS tile
FROM {p}_merged_{track} WHERE f_{sfx} > 0 AND {covered}"""
        shown = [
            f"if(m.{prev} IS NULL, 1, {n}.tile) AS {n}" if n == "volatility_score" else f"coalesce({n}.tile, 1) AS {n}" for n in tilings
        ]
        CTES[f"{p}_tiles_{track}"] = f"""
SELECT m.*, {", ".join(shown)} FROM {p}_merged_{track} m
{" ".join(f"LEFT JOIN {p}_{n}_{track} {n} ON m.user_id IS NOT DISTINCT FROM {n}.user_id" for n in tilings)} WHERE m.f_{sfx} > 0"""
        CTES[f"{p}_total_{track}"] = f"""
SELECT *, CAST(round({" + ".join(f"{n} * {w}" for n, w in zip(labels.SCORE_NAMES, labels.SCORE_WEIGHTS) if w)}, 2) AS DOUBLE) AS total_score FROM {p}_tiles_{track}"""
        CTES[f"{p}_cuts_{track}"] = f"""
SELECT quantile_cont(total_score, 0.4) AS cut1, quantile_cont(total_score, 0.7) AS cut2, quantile_cont(total_score, 0.9) AS cut3 FROM {p}_total_{track}"""
        CTES[f"{p}_scored_{track}"] = f"""
SELECT tgt, user_id, gender, strftime(join_dt, '%y-%m') AS join_group, {age("birth_year", f"DATE '{as_of}'")} AS age_group, platform,
  total_accumulate_cash, current_cash, total_accumulate_shoji, current_shoji, {"first_order_dt, refund_rate," if mall else ""} terms_agree_yn,
  r_{sfx}, f_{sfx}, m_{sfx}, round(CAST(m_{sfx} AS DOUBLE) / f_{sfx}, 2) AS ar_{sfx}, {term}, {prev}, {term} - {prev} AS term_diff_{sfx},
  cycle_stddev_{sfx}, r_score, f_score, m_score, term_score, term_diff_score, volatility_score, total_score, cycle_length_{sfx}, risk_level_{sfx},
  round(suvival_prob_{sfx}, 2) AS suvival_prob_{sfx}, round(predicted_survival_time_{sfx}) AS predicted_survival_time_{sfx},
  {", ".join(f"{k}_{cat} AS {k}" for k in RANKING_COLUMNS)}, DATE '{as_of}' AS snapshot_dt, cut1, cut2, cut3,
  {above("total_score", [(f"cut{3 - i}", g) for i, (_, g) in enumerate(labels.GRADE_PERCENTILES)])} AS grade
FROM {p}_total_{track}, {p}_cuts_{track}"""
    CTES[f"{p}_arecords"] = f"""
SELECT user_id, gender, age_group, join_group, platform, terms_agree_yn, snapshot_dt, tgt, total_score, cut1, cut2, cut3, grade,
  risk_level_byshop AS risk_level, cycle_length_byshop AS cycle_length, r_score, f_score, m_score, term_score, term_diff_score, volatility_score,
  r_byshop AS r_data, f_byshop AS f_data, m_byshop AS m_data, ar_byshop AS ar_data, current_trailing_term_byshop AS current_trailing_term,
  prev_trailing_term_byshop AS prev_trailing_term, term_diff_byshop AS term_diff, cycle_stddev_byshop AS cycle_stddev,
  suvival_prob_byshop AS survival_prob, predicted_survival_time_byshop AS predicted_survival_time, total_accumulate_cash,
  total_accumulate_shoji, current_cash, current_shoji
FROM {p}_scored_affiliate WHERE user_id IS NOT NULL"""
    CTES[f"{p}_records"] = f"""
SELECT user_id, gender, age_group, join_group, platform, terms_agree_yn, first_order_dt, snapshot_dt, total_score, cut1, cut2, cut3, grade,
  risk_level_shop AS risk_level, cycle_length_shop AS cycle_length, r_score, f_score, m_score, term_score, term_diff_score, volatility_score,
  r_shop AS r_data, f_shop AS f_data, m_shop AS m_data, ar_shop AS ar_data, current_trailing_term_shop AS current_trailing_term,
  prev_trailing_term_shop AS prev_trailing_term, term_diff_shop AS term_diff, cycle_stddev_shop AS cycle_stddev, refund_rate,
  suvival_prob_shop AS survival_prob, predicted_survival_time_shop AS predicted_survival_time, total_accumulate_cash,
  total_accumulate_shoji, current_cash, current_shoji, {", ".join(RANKING_COLUMNS)}
FROM {p}_scored_mall WHERE user_id IS NOT NULL"""


def chain(p: str, as_of: str, known: str = "TRUE") -> None:
    affiliate_ctes(f"{p}_fl", START, as_of, START, True)
    affiliate_ctes(f"{p}_log", START, as_of, PARTNER_CHURN_START, False)
    CTES[f"{p}_all_named"] = f"SELECT * FROM {p}_fl_all_named"
    activity_cte(p, f"{p}_fl_all", as_of)
    CTES[f"{p}_arfm"] = f"SELECT * FROM {p}_activity WHERE monetary > 0"
    mall_rfm_ctes(p, as_of, known)
    category_ctes(p, as_of)
    CTES[f"{p}_adays"] = f"SELECT DISTINCT user_id, event_dt AS order_dt FROM {p}_log_all"
    CTES[f"{p}_mdays"] = f"""
SELECT m.wk_id AS user_id, a.order_dt, a.member_no, m.gender, m.birth_year FROM (
  SELECT DISTINCT member_no, order_dt FROM src_mall_orders WHERE order_dt BETWEEN DATE '{START}' AND DATE '{as_of}') a
LEFT JOIN src_mall_members m ON a.member_no = m.member_no"""
    survival_ctes(f"{p}_sa", f"{p}_adays", as_of, grouped=False)
    survival_ctes(f"{p}_sm", f"{p}_mdays", as_of, grouped=True)
    merged_ctes(p, as_of)


DAY_BEFORE = "2001-07-31"
chain("c", AS_OF)
chain("d", DAY_BEFORE)
chain("e", EARLIER)
affiliate_ctes("y", "2001-01-01", AS_OF, "2001-01-01", True)
activity_cte("y", "y_all", "2001-03-31")


# --- presentation ---------------------------------------------------------------------------


def show(cte: str, dates: str = "", places: int = 6, rounded: str = "", cols: str = "*", where: str = "", **other: int) -> str:
    """SELECT with dates as text and doubles rounded as the Spark side presents them."""
    swap = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    swap += [f"round(CAST({c} AS DOUBLE), {other.get(c, places)}) AS {c}" for c in rounded.split()]
    if cols == "*":
        head = f"* REPLACE ({', '.join(swap)})" if swap else "*"
    else:
        by_name = {x.rsplit(" AS ", 1)[1]: x for x in swap}
        head = ", ".join(by_name.get(c, c) for c in cols.split())
    return f"SELECT {head} FROM {cte}{f' WHERE {where}' if where else ''}"


oracle(
    "order_window_scan",
    "SELECT * REPLACE (CAST(event_dt AS VARCHAR) AS event_dt, strftime(event_dttm, '%Y-%m-%d') AS event_dttm) FROM c_fl_win",
)
oracle(
    "order_window_stored",
    """SELECT * REPLACE (CAST(event_dt AS VARCHAR) AS event_dt, strftime(event_dttm, '%Y-%m-%d') AS event_dttm) FROM c_fl_win
WHERE event_dt BETWEEN DATE '2001-05-15' AND DATE '2001-07-20'""",
)
oracle(
    "order_entry_label",
    f"SELECT event_action, {_ENTRY} AS entry, count(*) AS n, round(sum(price), 2) AS price FROM src_events GROUP BY 1, 2",
)
oracle(
    "mall_valid_orders",
    show("c_valid", "order_dt join_dt", rounded="commission_rate first_pay_amt"),
)
oracle(
    "scalar_null",
    """SELECT c_custkey, CAST(CASE WHEN c_nationkey = 13 THEN -1 ELSE c_nationkey END AS BIGINT) AS nation_or_default,
  nullif(c_mktsegment, 'MACHINERY') AS segment_or_null,
  round(CASE WHEN c_nationkey <> 0 THEN c_acctbal / c_nationkey END, 6) AS ratio,
  CASE WHEN c_nationkey <> 7 THEN CAST(greatest(c_nationkey, 5) AS DOUBLE) END AS greatest_or_null,
  round(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END, 6) AS floored FROM customer""",
)
oracle(
    "scalar_math",
    f"""SELECT c_custkey, round(c_acctbal) AS whole, round(c_acctbal, 1) AS tenth, {half_up("c_acctbal / 7", 2)} AS half_up,
  CAST(floor(c_acctbal / 7) AS BIGINT) AS week_floor, abs(c_acctbal) AS magnitude, -c_acctbal AS negated,
  round(exp(-abs(c_acctbal) / 1000), 6) AS decay, round(ln(nullif(abs(c_acctbal), 0)), 6) AS log, round(ln(1 + abs(c_acctbal)), 6) AS log1p,
  round(sqrt(abs(c_acctbal)), 6) AS root, round(pow(abs(c_acctbal) / 1000, 1.5), 6) AS power,
  least(greatest(c_acctbal, 0), 5000) AS clipped, {to_long("c_acctbal")} AS as_long FROM customer""",
)
oracle(
    "scalar_date",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y%m%d') AS compact,
  CAST(CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS VARCHAR) AS parsed,
  CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS days_ago,
  year(o_orderdate) AS year FROM orders""",
)
_INNER = "CASE WHEN p_size > 40 THEN ' ' WHEN p_size < 5 THEN NULL ELSE p_brand END"
oracle(
    "scalar_text",
    f"""SELECT p_partkey, replace(p_type || '/' || p_size, '/', '-') AS cleaned,
  replace(p_type || '/' || p_size, '/', '-') || '(' || coalesce(nullif(trim({_INNER}), ''), '{labels.NO_SUBCATEGORY}') || ')' AS nested,
  trim('  ' || p_name || ' ') AS trimmed, p_name LIKE 'small%' AS is_small,
  coalesce(trim({_INNER}) NOT IN ('', 'None'), FALSE) AS has_inner FROM part""",
)
oracle(
    "numeric_coerce",
    """SELECT p_partkey, round(TRY_CAST(CASE WHEN p_size % 3 = 0 THEN p_brand ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE), 6) AS number,
  TRY_CAST(p_brand AS BIGINT) AS whole FROM part""",
)
oracle("age_group", f"SELECT member_no, birth_year, {age('birth_year', f'''DATE '{AS_OF}' ''')} AS age_group FROM src_mall_members")
oracle("join_group", "SELECT user_id, CAST(join_dt AS VARCHAR) AS join_dt, strftime(join_dt, '%y-%m') AS join_group FROM src_app_members")

oracle("order_revenue_rollup", show("c_fl_order", "event_dt", rounded="revenue"))
oracle("order_revenue_rollup_by_name", show("c_fl_order_named", "event_dt", rounded="revenue"))
oracle("refund_revenue_rollup", show("c_fl_refund", "event_dt", rounded="revenue"))
oracle("net_order_revenue", show("c_fl_net", "event_dt", rounded="revenue"))
oracle(
    "net_order_revenue_refunds_summed",
    """SELECT CAST(o.event_dt AS VARCHAR) AS event_dt, o.* EXCLUDE (event_dt, revenue),
  CASE WHEN o.revenue + coalesce(r.refund, 0) < 0 THEN 0 ELSE o.revenue + coalesce(r.refund, 0) END AS revenue
FROM c_fl_order o LEFT JOIN (SELECT user_id, transaction_id, sum(revenue) AS refund FROM c_fl_refund GROUP BY 1, 2) r
  ON o.user_id = r.user_id AND o.transaction_id = r.transaction_id""",
)
oracle("partner_daily", show("c_fl_pday", "event_dt", 4, "revenue"))
oracle("partner_cancel_daily", show("c_fl_pcan", "event_dt order_date", 4, "revenue"))
oracle("net_partner_revenue", show("c_fl_netp", "event_dt", 4, "revenue"))
oracle("combined_purchases", show("c_fl_all", "event_dt", 4, "revenue"))
oracle("purchase_log", show("c_log_all", "event_dt", 4, "revenue"))

_RFM_DATES = "join_dt snapshot_dt"
oracle("rfm_affiliate", show("c_arfm", _RFM_DATES, 4, "monetary"))
oracle("member_activity", show("y_activity", _RFM_DATES, 4, "monetary"))
_MALL_DATES = "join_dt last_order_dt first_order_dt snapshot_dt"
oracle("rfm_mall", show("c_rfm", _MALL_DATES, rounded="monetary avg_commission_rate refund_rate", monetary=2))
oracle("rfm_mall_orders_once", show("c_rfm_once", _MALL_DATES, rounded="monetary avg_commission_rate refund_rate", monetary=2))
oracle(
    "mall_refund_flag",
    """SELECT order_no, member_no, CAST(order_dt AS VARCHAR) AS order_dt, CAST(count_if(is_refunded) AS BIGINT) AS hits, count(refund_no) AS refunds,
  bool_or(is_refunded) AS is_refunded FROM c_checked GROUP BY order_no, member_no, order_dt""",
)
oracle("reward_balance", "SELECT * FROM c_balance")

for _name, _cte in (("category_interest_depth1", "c_int1"), ("category_interest_depth2", "c_int2"),
                    ("mall_category_interest_depth1", "c_mint1"), ("mall_category_interest_depth2", "c_mint2")):
    oracle(_name, show(_cte, rounded="score interest_ratio"))
oracle("category_rank", "SELECT * FROM c_rank2")
oracle("category_power", "SELECT * FROM c_power")
oracle("mall_category_power", "SELECT * FROM c_mpower")
oracle(
    "category_or_join",
    """SELECT o.order_no, CAST(o.order_dt AS VARCHAR) AS order_dt, o.member_no, o.category_no, b.*
FROM src_mall_orders o LEFT JOIN src_mall_categories b ON b.depth4_category_no = o.category_no OR b.depth3_category_no = o.category_no""",
)

oracle("purchase_ranks", show("c_sa_base_data", "order_dt"))
oracle("purchase_intervals", show("c_sa_gaps", "order_dt next_order_date"))
_CYCLE = """SELECT c.user_id, c.current_trailing_term, p.prev_trailing_term, round(s.cycle_stddev, 6) AS cycle_stddev
FROM {c} c LEFT JOIN {p} p ON c.user_id = p.user_id LEFT JOIN {s} s ON c.user_id = s.user_id"""
oracle("cycle_stats", _CYCLE.format(c="c_sa_current", p="c_sa_prev", s="c_sa_spread"))
CTES["late_gaps"] = """
SELECT user_id, date_diff('day', order_dt, lead(order_dt) OVER (PARTITION BY user_id ORDER BY order_dt)) AS days_between_orders, recency_rank
FROM c_sa_base_data WHERE recency_rank <= 15"""
_LATE = f"""(SELECT user_id, {half_up("avg(days_between_orders)", 1)} AS {{k}}_trailing_term FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY recency_rank) AS back FROM late_gaps WHERE days_between_orders IS NOT NULL)
  WHERE back BETWEEN {{r}} GROUP BY user_id)"""
oracle("cycle_stats_latest", _CYCLE.format(c=_LATE.format(k="current", r="1 AND 3"), p=_LATE.format(k="prev", r="2 AND 4"),
       s="(SELECT user_id, stddev_samp(days_between_orders) AS cycle_stddev FROM late_gaps WHERE days_between_orders IS NOT NULL GROUP BY user_id)"))
_BASE = "current_trailing_term prev_trailing_term cycle_stddev cycle_change_rate cycle_variation_rate"
oracle("survival_base", show("c_sa_base", rounded=_BASE))
oracle("survival_base_grouped", show("c_sm_base", rounded=_BASE))
oracle("first_time_buyers", "SELECT * FROM c_sa_new")
oracle("term_stats", show("c_sa_tstats", rounded="log_stddev log_mean pop_stddev pop_mean"))
oracle(
    "term_median_mad",
    show("(SELECT * FROM c_sa_median, c_sa_mad)", rounded="median_term log_median_term mad log_mad"),
)
oracle(
    "term_median_approx",
    """SELECT count(*) AS n, count(*) AS counted, TRUE AS within_bound FROM c_sa_gaps
WHERE days_between_orders IS NOT NULL AND next_order_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""",
)
oracle(
    "robust_zscore",
    show("c_sa_robust", rounded="pop_mean modified_zscore", cols="user_id current_trailing_term pop_mean modified_zscore"),
)
oracle("churn_flag", "SELECT user_id, current_trailing_term, churn_flag FROM c_sa_churn")
for _name, _cte in (("churn_rate", "c_sa_rates"), ("churn_rate_by_group", "c_sm_rates")):
    oracle(
        _name,
        f"""SELECT * REPLACE (round(avg_churn_rate, 6) AS avg_churn_rate, {half_up("avg_group_term", 6)} AS avg_group_term) FROM {_cte}""",
    )
oracle("survival_buckets", "SELECT * FROM c_sa_buckets")
oracle("survival_curve", "SELECT * FROM c_sa_curve")
oracle("survival_grid_interpolate", show("c_sm_buckets", rounded="n_risk n_events"))
oracle("survival_curve_grouped", show("c_sm_curve", rounded="n_risk n_events"))
_INDIV = "modified_zscore avg_churn_rate avg_group_term survival_prob"
oracle("survival_individual", show("c_sa_indiv", rounded=_INDIV))
oracle("survival_individual_grouped", show("c_sm_indiv", rounded=_INDIV))
_TABLE = "modified_zscore demographic_churn_rate survival_prob predicted_survival_time"
oracle("survival_table", show("c_sa_table", "cur", rounded=_TABLE))
oracle("survival_table_grouped", show("c_sm_table", "cur", rounded=_TABLE))

_FILL_COLS = (
    "user_id platform join_dt cum_lifetime gender birth_year terms_agree_yn total_accumulate_cash total_accumulate_shoji current_cash "
    "current_shoji last_purchase_shop last_purchase_byshop ranking_1_1_sp ranking_2_6_sp power_2_6_sp ranking_1_1_bs ranking_2_6_bs power_2_6_bs"
)
oracle("user_profile_fill", show("c_merged_affiliate", "join_dt", cols=_FILL_COLS))
_MERGED = "suvival_prob_shop predicted_survival_time_shop suvival_prob_byshop predicted_survival_time_byshop m_total"
oracle("merged_affiliate", show("c_merged_affiliate", "join_dt snapshot_dt", 4, _MERGED))
oracle("merged_mall", show("c_merged_mall", "join_dt snapshot_dt first_order_dt", 4, _MERGED))
for _key, _score in {
    "score_recency": "r_score", "score_frequency": "f_score", "score_monetary": "m_score", "score_term": "term_score",
    "score_term_diff": "term_diff_score", "score_volatility": "volatility_score",
}.items():
    oracle(_key, f"SELECT user_id, {_score} FROM c_tiles_affiliate")
_SCORED = "ar_{0} term_diff_{0} cut1 cut2 cut3"
oracle("rfm_scores", show("c_scored_affiliate", "snapshot_dt", 4, _SCORED.format("byshop")))
oracle("rfm_scores_mall", show("c_scored_mall", "snapshot_dt first_order_dt", 4, _SCORED.format("shop")))
oracle("grade_cuts", show("c_cuts_affiliate", rounded="cut1 cut2 cut3"))
oracle(
    "grade_assign",
    f"""SELECT user_id, total_score, {above("total_score", [(f"q[{3 - i}]", g) for i, (_, g) in enumerate(labels.GRADE_PERCENTILES)])} AS grade
FROM c_records, (SELECT quantile_cont(total_score, [0.4, 0.7, 0.9]) AS q FROM c_records)""",
)
oracle("grade_fixed", f"SELECT user_id, total_score, {above('total_score', labels.GRADE_THRESHOLDS)} AS grade FROM c_records")

_RECORD_COLS = """snapshot_dt total_score cut1 cut2 cut3 grade risk_level cycle_length r_score f_score m_score term_score term_diff_score
 volatility_score r_data f_data m_data ar_data current_trailing_term prev_trailing_term term_diff cycle_stddev refund_rate survival_prob
 predicted_survival_time total_accumulate_cash total_accumulate_shoji current_cash current_shoji"""
_RECORD_ROUND = "cut1 cut2 cut3 ar_data term_diff refund_rate"
oracle(
    "history_pack",
    show("c_records", "snapshot_dt first_order_dt", 4, _RECORD_ROUND, cols=f"user_id gender age_group join_group first_order_dt {_RECORD_COLS}"),
)
CTES["both_dates"] = "SELECT * FROM e_records UNION ALL SELECT * FROM c_records"
_LATEST_SLOW = "coalesce(c.user_id, e.user_id) AS user_id, " + ", ".join(
    f"CASE WHEN c.user_id IS NOT NULL THEN c.{k} ELSE e.{k} END AS {k}"
    for k in ("gender", "age_group", "join_group", "platform", "terms_agree_yn", "first_order_dt")
)
CTES["latest_slow"] = f"SELECT {_LATEST_SLOW} FROM c_records c FULL JOIN e_records e ON c.user_id = e.user_id"
oracle(
    "history_upsert",
    """SELECT b.user_id, s.age_group, count(*) OVER (PARTITION BY b.user_id) AS records, count(*) OVER (PARTITION BY b.user_id) AS category_records,
  CAST(b.snapshot_dt AS VARCHAR) AS snapshot_dt, b.total_score, b.grade, b.r_data, b.f_data, b.m_data
FROM both_dates b JOIN latest_slow s ON b.user_id = s.user_id""",
)
ORACLES["history_upsert_bucketed"] = ORACLES["history_upsert"]
oracle(
    "history_pack_affiliate",
    show(
        "c_arecords", "snapshot_dt", 4, _RECORD_ROUND.replace(" refund_rate", ""),
        cols=f"user_id gender age_group join_group tgt {_RECORD_COLS.replace(' refund_rate', '')}",
    ),
)


def _two_dates(old: str, new: str) -> str:
    """The records of two dates, beside the age group of the user's latest."""
    return f"""SELECT b.user_id,
  last_value(b.age_group) OVER (PARTITION BY b.user_id ORDER BY b.snapshot_dt ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS age_group,
  count(*) OVER user_rows AS records, count(*) OVER user_rows AS category_records,
  CAST(b.snapshot_dt AS VARCHAR) AS snapshot_dt, b.total_score, b.grade, b.r_data, b.f_data, b.m_data
FROM (SELECT user_id, age_group, snapshot_dt, total_score, grade, r_data, f_data, m_data FROM {old}
  UNION ALL SELECT user_id, age_group, snapshot_dt, total_score, grade, r_data, f_data, m_data FROM {new}) b
WINDOW user_rows AS (PARTITION BY b.user_id)"""


oracle("history_upsert_affiliate", _two_dates("e_arecords", "c_arecords"))
oracle(
    "series_history",
    f"""SELECT *, 'affiliate' AS track FROM ({_two_dates("d_arecords", "c_arecords")})
UNION ALL SELECT *, 'mall' AS track FROM ({_two_dates("d_records", "c_records")})""",
)
_SLOW = "user_id gender age_group join_group platform terms_agree_yn first_order_dt"
oracle(
    "history_at",
    show(
        "(SELECT s.*, e.* EXCLUDE (user_id, gender, age_group, join_group, platform, terms_agree_yn, first_order_dt) FROM e_records e JOIN latest_slow s ON e.user_id = s.user_id)",
        "snapshot_dt first_order_dt", 4, _RECORD_ROUND, cols=f"{_SLOW} {_RECORD_COLS}",
    ),
)
oracle(
    "history_categories_at",
    show("c_records", "snapshot_dt first_order_dt", cols=f"user_id gender platform terms_agree_yn first_order_dt snapshot_dt {' '.join(RANKING_COLUMNS)}"),
)
oracle("history_long_cycle", "SELECT user_id, cycle_length, r_score, f_score, m_score FROM c_records WHERE cycle_length = '장기'")


# --- weight study ----------------------------------------------------------------------------

_SCORES = list(labels.SCORE_NAMES)
_IMPORTANCE = labels.STUDY_IMPORTANCE
_START_W = labels.STUDY_START_WEIGHTS
_LOW_UNITS = [0, 64, 112, 0, 0, 0]
_MEDIANS = ["current_trailing_term", "m_data", "predicted_survival_time"]

CTES["filled"] = f"""
SELECT r.* REPLACE ({", ".join(f"coalesce(CAST(r.{c} AS DOUBLE), g.md_{c}) AS {c}" for c in _MEDIANS)},
  {", ".join(f"coalesce(CAST(r.{c} AS DOUBLE), g.mn_{c}) AS {c}" for c in _SCORES)})
FROM c_records r, (SELECT {", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS md_{c}" for c in _MEDIANS)},
  {", ".join(f"min({c}) AS mn_{c}" for c in _SCORES)} FROM c_records) g"""
CTES["split_rows"] = """
SELECT *, CASE WHEN CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM filled"""
CTES["one_group"] = "SELECT *, 'all' AS split FROM filled"


def ltv_ctes(p: str, source: str) -> None:
    again = "f_data > 1"
    CTES[f"{p}_quality"] = f"""
SELECT *, CASE WHEN {again} THEN m_data / f_data * ln(1 + f_data) ELSE m_data * 0.7 END AS quality FROM {source}"""
    term01 = "CASE WHEN current_trailing_term = 0 THEN 0.1 ELSE current_trailing_term END"
    term1 = "CASE WHEN current_trailing_term = 0 THEN 1 ELSE current_trailing_term END"
    CTES[f"{p}_raw"] = f"""
SELECT q.*, (m_data / ({term1}) * CASE WHEN {again} THEN 1.3 ELSE 0.7 END)
  * (predicted_survival_time * CASE WHEN {again} THEN 1 ELSE 0.3 END / sqrt({term01}) * CASE WHEN {again} THEN 1 + ln(1 + f_data) * 0.2 ELSE 1 END)
  * (1 + CASE WHEN {again} THEN pow(f_data, 1.5) ELSE 0.5 END) * least(greatest(quality / p50, 0), p95 / p50)
  * CASE WHEN {again} THEN 1 + ln(1 + f_data) * 0.3 ELSE 0.6 END AS raw_value
FROM {p}_quality q JOIN (SELECT split AS s, quantile_cont(quality, 0.5) AS p50, quantile_cont(quality, 0.95) AS p95 FROM {p}_quality GROUP BY split) g ON q.split = g.s"""
    CTES[f"{p}_valued"] = f"""
SELECT r.*, least(greatest(raw_value, 0), CASE WHEN {again} THEN c97 ELSE c95 END) AS adjusted_ltv
FROM {p}_raw r JOIN (SELECT split AS s, quantile_cont(raw_value, 0.97) AS c97, quantile_cont(raw_value, 0.95) AS c95 FROM {p}_raw GROUP BY split) g ON r.split = g.s"""


ltv_ctes("whole", "one_group")
ltv_ctes("parts", "split_rows")


def dot(weights) -> str:
    return " + ".join(f"{s} * {w}" for s, w in zip(_SCORES, weights))


def spread(weights) -> str:
    mean = f"(({' + '.join(weights)}) / 6)"
    return f"(({' + '.join(f'({w} - {mean}) * ({w} - {mean})' for w in weights)}) / 6)"


def corr_of(weights) -> str:
    own = " + ".join(f"{weights[i]} * {weights[j]} * v{i}{j} * {1 if i == j else 2}" for i in range(6) for j in range(i, 6))
    return f"(({' + '.join(f'{w} * c{i}' for i, w in enumerate(weights))}) / (sqrt({own}) * sqrt(lv)))"


def objective_of(weights) -> str:
    bonus = " + ".join(f"{w} * {b}" for w, b in zip(weights, _IMPORTANCE))
    return f"({corr_of(weights)} - 0.1 * {spread(weights)} + {bonus})"


CTES["moment_row"] = f"""
SELECT var_samp(adjusted_ltv) AS lv, {", ".join(f"covar_samp({s}, adjusted_ltv) AS c{i}" for i, s in enumerate(_SCORES))},
  {", ".join(f"covar_samp({_SCORES[i]}, {_SCORES[j]}) AS v{i}{j}" for i in range(6) for j in range(i, 6))}
FROM parts_valued WHERE split = 'train'"""
_UNIT_W = [f"(u{i} / 320.0::DOUBLE)" for i in range(6)]
_PICK = f"""SELECT u0, u1, u2, u3, u4, u5, {objective_of(_UNIT_W)} AS objective FROM {{source}}, moment_row
ORDER BY round(objective, 12) DESC, u0, u1, u2, u3, u4, u5 LIMIT 1"""
CTES["grid_start"] = f"""
SELECT k0 * 16 AS u0, 64 + k1 * 16 AS u1, 112 + k2 * 16 AS u2, k3 * 16 AS u3, k4 * 16 AS u4, 320 - 176 - (k0 + k1 + k2 + k3 + k4) * 16 AS u5
FROM {", ".join(f"range(0, 10) t{i}(k{i})" for i in range(5))} WHERE k0 + k1 + k2 + k3 + k4 <= 9"""
CTES["best_start"] = _PICK.format(source="grid_start")
for _prev, _name, _step in (("best_start", "best_mid", 4), ("best_mid", "best_fine", 1)):
    _moved = [f"(u{i} + d{i} * {_step})" for i in range(5)]
    CTES[f"grid_{_name}"] = f"""
SELECT * FROM (SELECT {", ".join(f"{m} AS u{i}" for i, m in enumerate(_moved))}, 320 - {" - ".join(_moved)} AS u5
FROM {_prev}, {", ".join(f"range(-4, 5) t{i}(d{i})" for i in range(5))})
WHERE {" AND ".join(f"u{i} BETWEEN {lo} AND 320" for i, lo in enumerate(_LOW_UNITS))}"""
    CTES[_name] = _PICK.format(source=f"grid_{_name}")
CTES["found_weights"] = f"SELECT {', '.join(f'{w} AS w{i}' for i, w in enumerate(_UNIT_W))}, objective FROM best_fine"
_FOUND = [f"w{i}" for i in range(6)]

oracle(
    "preprocess_fill",
    show("filled", rounded=" ".join(_MEDIANS + _SCORES), cols=f"user_id {' '.join(_MEDIANS + _SCORES)}"),
)
oracle(
    "train_test_split",
    "SELECT user_id, CASE WHEN CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM src_app_members",
)
oracle("adjusted_ltv", show("whole_valued", places=2, rounded="m_data adjusted_ltv", cols="user_id f_data m_data adjusted_ltv"))
oracle("weighted_score", f"SELECT user_id, round({dot(_START_W)}, 6) AS score FROM filled")
_VAR_START = spread([f"{w}::DOUBLE" for w in _START_W])
_BONUS_START = " + ".join(f"{w} * {b}::DOUBLE" for w, b in zip(_START_W, _IMPORTANCE))
oracle(
    "score_ltv_corr",
    f"""SELECT n, round(k, 6) AS correlation, round(k - 0.1 * {_VAR_START}, 6) AS objective_plain,
  round(k - 0.1 * {_VAR_START} + {_BONUS_START}, 6) AS objective_importance
FROM (SELECT count(*) AS n, corr({dot(_START_W)}, adjusted_ltv) AS k FROM whole_valued)""",
)
oracle(
    "weight_search",
    f"""SELECT {", ".join(f"round(w{i}, 6) AS w{i}" for i in range(6))}, round(objective, 6) AS objective,
  round((SELECT corr({dot(_FOUND)}, adjusted_ltv) FROM parts_valued, found_weights WHERE split = 'train'), 6) AS correlation FROM found_weights""",
)
_LEAST = labels.STUDY_MIN_WEIGHTS
_DRAWN = [
    f"CASE WHEN s = 0 THEN {w}::DOUBLE ELSE CAST('0x' || substr(md5(s || '|{i}'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE END"
    for i, w in enumerate(labels.STUDY_START_WEIGHTS)
]


def _onto_simplex(keep: str, moved: list[str], source: str) -> str:
    """Select of `keep` and the projection w0..w5 of the moved weights."""
    levels = [f"(list_sum(o[1:{k}]) - {1 - sum(_LEAST)}) / {k}" for k in range(1, 7)]
    weights = [f"greatest(p[{i + 1}] - level, 0) + {low}::DOUBLE AS w{i}" for i, low in enumerate(_LEAST)]
    return f"""SELECT {keep}, {", ".join(weights)} FROM (SELECT *, greatest({", ".join(levels)}) AS level
  FROM (SELECT *, list_sort(p, 'DESC') AS o FROM (SELECT *, [{", ".join(f"{m} - {low}::DOUBLE" for m, low in zip(moved, _LEAST))}] AS p FROM {source})))"""


_SLOPES = [" + ".join(f"w{j} * v{min(i, j)}{max(i, j)}" for j in range(6)) for i in range(6)]
_OWN = " + ".join(f"w{i} * ({slope})" for i, slope in enumerate(_SLOPES))
_RISES = [
    f"(c{i} - common * ({_SLOPES[i]}) / own) / sqrt(own * lv) - 0.2 * (w{i} - mean) / 6 + {b}" for i, b in enumerate(labels.STUDY_IMPORTANCE)
]
CTES["weight_paths"] = f"""
WITH RECURSIVE path AS (
  {_onto_simplex("s, 0 AS t", _DRAWN, "range(0, 10) starts(s)")}
  UNION ALL
  {_onto_simplex("s, t + 1 AS t", [f"(w{i} + 0.05 * ({g}))" for i, g in enumerate(_RISES)],
    f"(SELECT *, {' + '.join(f'w{i} * c{i}' for i in range(6))} AS common, {_OWN} AS own, (w0 + w1 + w2 + w3 + w4 + w5) / 6 AS mean FROM path, moment_row WHERE t < 400)")}
)
SELECT s AS start, w0, w1, w2, w3, w4, w5, {objective_of(_FOUND)} AS objective FROM path, moment_row"""
CTES["weight_ends"] = f"""
SELECT start, {", ".join(f"arg_max(w{i}, objective) AS w{i}" for i in range(6))}, max(objective) AS objective FROM weight_paths GROUP BY start"""
oracle(
    "weight_search_starts",
    f"""SELECT start, {", ".join(f"round(w{i}, 4) AS w{i}" for i in range(6))}, round(objective, 6) AS objective,
  row_number() OVER (ORDER BY round(objective, 6) DESC, start) = 1 AS best FROM weight_ends""",
)
oracle(
    "weight_compare",
    f"""SELECT split, round(corr({dot(_START_W)}, adjusted_ltv), 6) AS original_corr, round(corr({dot(_FOUND)}, adjusted_ltv), 6) AS optimized_corr
FROM parts_valued, found_weights GROUP BY split""",
)
_P = 2147483647
oracle(
    "bootstrap_corr",
    f"""SELECT round(quantile_cont(o, 0.025), 6) AS original_low, round(quantile_cont(o, 0.975), 6) AS original_high,
  round(quantile_cont(p, 0.025), 6) AS optimized_low, round(quantile_cont(p, 0.975), 6) AS optimized_high, round(avg(p) - avg(o), 6) AS improvement
FROM (SELECT rep, corr(a_score, adjusted_ltv) AS o, corr(b_score, adjusted_ltv) AS p
  FROM (SELECT adjusted_ltv, {dot(_START_W)} AS a_score, {dot(_FOUND)} AS b_score,
      CAST('0x' || substr(md5(user_id), 1, 8) AS BIGINT) % {_P} AS a, CAST('0x' || substr(md5(user_id), 9, 8) AS BIGINT) % {_P} AS b
    FROM parts_valued, found_weights WHERE split = 'test'),
    range(1, 1001) r(rep)
  WHERE (a + b * rep) % {_P} < {int(0.8 * _P)} GROUP BY rep)""",
)


# --- segments ----------------------------------------------------------------------------------

_EVENT_USERS = "SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type <> 'signup' AND CAST(ts AS DATE) >= DATE '{}' AND {}"
oracle(
    "campaign_funnel",
    f"""SELECT user_id, current_cash, 'coupon' AS funnel FROM src_app_members WHERE user_id IN (
  {_EVENT_USERS.format("2024-01-05", """event_type = 'click' AND props LIKE '{"k": 1%'""")}
  UNION ALL {_EVENT_USERS.format("2024-01-01", "event_type = 'signup'")})
UNION ALL SELECT user_id, current_cash, 'exchange' AS funnel FROM src_app_members WHERE user_id IN (
  {_EVENT_USERS.format("2024-01-10", "event_type = 'purchase'")}
  UNION ALL {_EVENT_USERS.format("2024-01-20", "event_type = 'view'")})""",
)
_BANDS = [(lo, 1e18 if hi is None else hi, label) for lo, hi, label in labels.CASH_BANDS]
oracle(
    "cash_band_profile",
    f"""SELECT b.band, count(m.user_id) AS users, CAST(coalesce(sum(m.current_cash), 0) AS DOUBLE) AS total_cash
FROM (VALUES {", ".join(f"({lo}, {hi}, '{label}')" for lo, hi, label in _BANDS)}) b(lo, hi, band)
LEFT JOIN src_app_members m ON m.current_cash > b.lo AND m.current_cash <= b.hi GROUP BY b.band""",
)
oracle(
    "balance_summary",
    """SELECT CAST(sum(current_cash) AS DOUBLE) AS total_cash, CAST(max(current_cash) AS DOUBLE) AS max_cash, count(*) - count(current_cash) AS missing,
  CAST(count_if(current_cash > 0) AS BIGINT) AS positive_users, round(sum(current_cash) / count_if(current_cash > 0), 6) AS cash_per_positive_user FROM src_app_members""",
)
_MEANS = [
    "total_score", "cut1", "cut2", "cut3", "r_data", "f_data", "term_score", "term_diff_score", "volatility_score", "refund_rate",
    "survival_prob", "predicted_survival_time", "total_accumulate_cash", "total_accumulate_shoji", "current_cash", "current_shoji",
]
oracle(
    "grade_profile",
    f"""SELECT grade, {", ".join(f"round(avg({c}), 6) AS {c}_mean" for c in _MEANS)}, count(*) AS n,
  {", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS {c}_median" for c in ("m_data", "ar_data"))} FROM c_records GROUP BY grade""",
)
oracle(
    "cycle_profile",
    f"""SELECT cycle_length, {", ".join(f"round(avg({c}), 6) AS {c}_mean" for c in ("predicted_survival_time", "r_score", "f_score", "m_score"))},
  count(*) AS n FROM c_records GROUP BY cycle_length""",
)
oracle("grade_counts", "SELECT grade, count(*) AS n FROM c_records GROUP BY grade")
oracle("score_histogram", "SELECT grade, f_data AS f_bin, count(*) AS n FROM c_records WHERE m_data < 1500000 GROUP BY 1, 2")

CTES["density_value"] = " UNION ALL ".join(
    f"SELECT grade, '{m}' AS measure, CAST({m} AS DOUBLE) AS v FROM c_records WHERE {m} IS NOT NULL" for m in ("r_data", "f_data", "m_data", "ar_data")
)
CTES["density_grid"] = """
SELECT grade, measure, n, h, lo - 3 * h AS x0, (hi - lo + 6 * h) / 199 AS step
FROM (SELECT grade, measure, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, max(v) AS hi FROM density_value GROUP BY 1, 2) WHERE h > 0"""
CTES["density_weight"] = """
SELECT grade, measure, bin, sum(w) AS w FROM (
  SELECT grade, measure, unnest([floor(t), floor(t) + 1]) AS bin, unnest([1 - (t - floor(t)), t - floor(t)]) AS w
  FROM (SELECT v.grade, v.measure, (v.v - g.x0) / g.step AS t FROM density_value v JOIN density_grid g ON v.grade = g.grade AND v.measure = g.measure)
) GROUP BY 1, 2, 3"""
oracle(
    "score_density",
    """SELECT g.grade, g.measure, p.point, round(g.x0 + p.point * g.step, 3) AS x,
  round(sum(w.w * exp(-pow((p.point - w.bin) * g.step / g.h, 2) / 2)) / (g.n * g.h * sqrt(2 * pi())), 12) AS density
FROM density_grid g JOIN density_weight w ON w.grade = g.grade AND w.measure = g.measure, range(0, 200) p(point)
GROUP BY g.grade, g.measure, p.point, g.x0, g.step, g.n, g.h""",
)

CTES["quintiles"] = """
SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qr, quantile_cont(CAST(frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qf,
  quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS qm FROM e_arfm"""


def _passed(c: str, q: str) -> str:
    return " + ".join(f"CASE WHEN {c} > {q}[{i}] THEN 1 ELSE 0 END" for i in range(1, 5))


CTES["periods"] = f"""
SELECT user_id, recency, frequency, monetary, CAST(5 - ({_passed("recency", "qr")}) AS BIGINT) AS r_score,
  CAST(1 + ({_passed("frequency", "qf")}) AS BIGINT) AS f_score, CAST(1 + ({_passed("monetary", "qm")}) AS BIGINT) AS m_score, period
FROM (SELECT *, 'past' AS period FROM e_arfm UNION ALL SELECT *, 'current' AS period FROM c_arfm), quintiles"""
CTES["vips"] = "SELECT * FROM periods WHERE r_score >= 4 AND f_score >= 4 AND m_score >= 4"
oracle(
    "past_quantiles",
    "SELECT i * 20 AS percent, round(qr[i], 4) AS recency, round(qf[i], 4) AS frequency, round(qm[i], 4) AS monetary FROM quintiles, range(1, 5) t(i)",
)
oracle("period_scores", show("periods", "", 4, "monetary"))
oracle(
    "vip_movement",
    """SELECT count(*) FILTER (period = 'past') AS past_vips, count(*) FILTER (period = 'current') AS current_vips,
  count(*) FILTER (period = 'current') - count(*) FILTER (period = 'past') AS net_change FROM vips""",
)
for _name, _have, _lack in (("vip_new", "current", "past"), ("vip_churned", "past", "current")):
    oracle(
        _name,
        f"""SELECT * EXCLUDE (period) REPLACE (round(monetary, 4) AS monetary) FROM vips
WHERE period = '{_have}' AND user_id NOT IN (SELECT user_id FROM vips WHERE period = '{_lack}')""",
    )
# The rule of a single date, applied to each date by itself.
_DATES = [f"2001-07-{d}" for d in range(26, 32)] + ["2001-08-01"]
for _i, _dt in enumerate(_DATES):
    affiliate_ctes(f"s{_i}", START, _dt, START, True)
    activity_cte(f"s{_i}", f"s{_i}_all", _dt)
oracle(
    "snapshot_series",
    " UNION ALL ".join(
        f"""SELECT user_id, CAST(snapshot_dt AS VARCHAR) AS snapshot_dt, recency, frequency, round(monetary, 4) AS monetary
FROM s{i}_activity WHERE round(monetary, 6) > 0"""
        for i in range(len(_DATES))
    ),
)


# The rules of the whole chain, applied to each date by itself; no date knows refunds that come after it.
_CHAIN_DATES = ["2001-07-28", "2001-07-29", "2001-07-30", "2001-07-31", AS_OF]
_CYCLES = """days_since_last_purchase, current_trailing_term, prev_trailing_term, cycle_stddev, round(modified_zscore, 6) AS modified_zscore, churn_flag,
  round(survival_prob, 6) AS survival_prob, cycle_length, risk_level"""
_RANKS = "ranking_1_1, power_1_1, ranking_1_3, ranking_2_1, power_2_1, ranking_2_6"
for _i, _dt in enumerate(_CHAIN_DATES):
    chain(f"g{_i}", _dt, f"order_dt <= DATE '{_dt}'")


def _chain_rows(p: str, on: str, track: str, rfm: str, power: str, cycles: str) -> str:
    return f"""SELECT '{on}' AS snapshot_dt, '{track}' AS track, user_id, recency, frequency, round(monetary, 4) AS monetary, {_RANKS}, {_CYCLES}
FROM (SELECT * FROM {p}_{rfm} WHERE user_id IS NOT NULL) FULL JOIN (SELECT * FROM {p}_{power} WHERE user_id IS NOT NULL) USING (user_id)
FULL JOIN (SELECT * FROM {p}_{cycles} WHERE user_id IS NOT NULL) USING (user_id)"""


oracle(
    "chain_series",
    " UNION ALL ".join(
        _chain_rows(f"g{i}", dt, *track)
        for i, dt in enumerate(_CHAIN_DATES)
        for track in (("affiliate", "arfm", "power", "sa_table"), ("mall", "rfm", "mpower", "sm_table"))
    ),
)

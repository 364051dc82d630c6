"""The registered queries as plain SQL over the given tables.

Written from the query definitions, with the joins and their repeated rows spelled out, so that a match
checks the Spark plans rather than repeating them. Amounts are doubles and dates ISO text in the results.
"""

from __future__ import annotations

DIMENSIONS = """
dim_courier as (
  select cast(r_regionkey+1 as int) courier_id, r_name courier_name,
    cast(48+24*(r_regionkey%3) as int) sla_hours from region),
dim_geography as (
  select n_nationkey geo_id, n_name city, concat('Tier-', cast(1+n_nationkey%3 as varchar)) tier, r_name zone_name
  from nation join region on n_regionkey=r_regionkey),
dim_merchant as (
  select concat('M-',cast(c_custkey as varchar)) merchant_id, c_name merchant_name, c_mktsegment category
  from customer)"""

ORDERS = """
fact_orders as (
  select o_orderkey, concat('ORD',cast(o_orderkey as varchar)) order_id,
    concat('AWB',cast(o_orderkey as varchar)) awb_number, cast(o_orderkey%5+1 as int) courier_id,
    concat('M-',cast(o_custkey as varchar)) merchant_id, c_nationkey geo_id, cast(o_orderdate as date) order_date,
    case when o_orderstatus in ('F','P') then 'DELIVERED' when o_orderkey%3=0 then 'RTO'
      when o_orderkey%3=1 then 'IN_TRANSIT' else 'LOST' end order_status,
    case when o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM') then 'COD' else 'Prepaid' end payment_mode,
    cast(case when o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM') then o_totalprice else 0 end
      as decimal(12,2)) cod_amount,
    cast((400+(o_orderkey*37)%8000)*0.001 as decimal(8,3)) declared_weight,
    cast(o_totalprice as decimal(12,2)) order_value, sla_hours promised_eta_hrs,
    case when o_orderstatus in ('F','P')
      then cast(sla_hours*(60+(o_orderkey*13)%90)*0.01 as decimal(8,2)) end actual_eta_hrs
  from orders join customer on c_custkey=o_custkey join dim_courier on courier_id=o_orderkey%5+1),
dim_date as (
  select order_date date_id, date_diff('day', order_date, date '2001-08-01') between 30 and 37 is_festival
  from (select distinct order_date from fact_orders))"""

SETTLEMENTS = """
order_lines as (
  select l_orderkey, count(*) n_lines, cast(round(min(l_discount)*100) as int) discount,
    cast(round(min(l_tax)*100) as int) tax, cast(min(l_quantity) as int) units, min(l_extendedprice) least_price,
    bool_and(l_returnflag='R') returned, bool_and(l_linestatus='O') still_open,
    year(min(l_shipdate)) first_year, year(max(l_shipdate)) last_year, day(max(l_shipdate)) last_day
  from lineitem group by l_orderkey),
settled as (
  select l_orderkey k, awb_number, courier_id, n_lines, first_year, last_year,
    cast(cod_amount*((100-greatest(discount-3,0))*0.01) as decimal(12,2)) settled_cod,
    cast(declared_weight*((200+3*tax)*0.005) as decimal(8,3)) charged_weight,
    cast((case when declared_weight<=1 then 42 when declared_weight<=3 then 65 else 95 end)*((200+units)*0.005)
      as decimal(10,2)) forward_charge,
    cast(case when returned then floor(least_price/100) else 0 end as decimal(10,2)) rto_charge,
    cast(cod_amount*0.015 as decimal(10,2)) cod_fee,
    cast(order_date + cast(last_day//2 + case when still_open then 14 else 0 end as int) as date) settlement_date
  from order_lines join fact_orders on o_orderkey=l_orderkey),
fact_settlements as (
  select concat('SET',cast(k as varchar),'-',cast(y as varchar)) settlement_id, awb_number,
    concat('RUN-',cast(y as varchar)) batch_id, courier_id, settlement_date, settled_cod, charged_weight,
    forward_charge, rto_charge, cod_fee
  from (
    select *, last_year y from settled
    union all select *, first_year from settled where n_lines>=8 and first_year<>last_year))"""


def _rule(kind: str, expected: str, actual: str, variance: str, severity: str, where: str, extra: str = "") -> str:
    return f"""
  select concat(s.awb_number,'|',s.batch_id,'|{kind}') discrepancy_id, s.awb_number, s.batch_id, s.courier_id,
    o.merchant_id, o.geo_id, '{kind}' discrepancy_type, cast({expected} as decimal(12,2)) expected_value,
    cast({actual} as decimal(12,2)) actual_value, cast({variance} as decimal(12,2)) variance_rs, {severity} severity
  from fact_settlements s join fact_orders o on o.awb_number=s.awb_number {extra} where {where}"""


def _grade(amount: str) -> str:
    return f"case when {amount} > 500 then 'HIGH' when {amount} > 100 then 'MEDIUM' else 'LOW' end"


_SLAB = "(case when o.declared_weight<=1 then 42 when o.declared_weight<=3 then 65 else 95 end)"
_DAYS = "date_diff('day', o.order_date, s.settlement_date)"
_KILOS = "(s.charged_weight-o.declared_weight)*60"

RULE_SQL = {
    "COD_SHORT_REMITTANCE": _rule(
        "COD_SHORT_REMITTANCE", "o.cod_amount", "s.settled_cod", "o.cod_amount-s.settled_cod",
        _grade("o.cod_amount-s.settled_cod"),
        "o.cod_amount>0 and s.settled_cod < o.cod_amount - least(o.cod_amount*0.02, 10)",
    ),
    "WEIGHT_DISPUTE": _rule(
        "WEIGHT_DISPUTE", "o.declared_weight", "s.charged_weight", f"round({_KILOS},0)", _grade(_KILOS),
        "s.charged_weight > o.declared_weight*1.10",
    ),
    "PHANTOM_RTO_CHARGE": _rule(
        "PHANTOM_RTO_CHARGE", "0", "s.rto_charge", "s.rto_charge", _grade("s.rto_charge"),
        "s.rto_charge>0 and o.order_status='DELIVERED'",
    ),
    "OVERDUE_REMITTANCE": _rule(
        "OVERDUE_REMITTANCE", "14", _DAYS, "s.settled_cod", f"case when {_DAYS}>28 then 'HIGH' else 'MEDIUM' end",
        f"{_DAYS}>14",
    ),
    "DUPLICATE_SETTLEMENT": _rule(
        "DUPLICATE_SETTLEMENT", "1", "t.cnt", "s.settled_cod", "'HIGH'", "true",
        "join (select awb_number, count(*) cnt from fact_settlements group by awb_number having count(*)>1) t"
        " on t.awb_number=s.awb_number",
    ),
    "ETA_SLA_BREACH": _rule(
        "ETA_SLA_BREACH", "o.promised_eta_hrs", "o.actual_eta_hrs", "0", "'LOW'",
        "o.order_status='DELIVERED' and o.actual_eta_hrs is not null and o.actual_eta_hrs > o.promised_eta_hrs*1.3",
    ),
    "EXCESS_FORWARD_CHARGE": _rule(
        "EXCESS_FORWARD_CHARGE", _SLAB, "s.forward_charge", f"s.forward_charge-{_SLAB}",
        _grade(f"s.forward_charge-{_SLAB}"), f"s.forward_charge > {_SLAB}*1.15",
    ),
}

DISCREPANCIES = "\nfact_discrepancies as (" + "\n  union all".join(RULE_SQL.values()) + ")"

MARKET = """
raw_orders as (
  select concat('O',cast(o_orderkey as varchar)) order_id,
    case when o_orderstatus in ('F','P') then 'delivered' else 'shipped' end order_status,
    o_orderdate order_purchase_timestamp,
    case when o_orderstatus in ('F','P') and o_orderkey%97<>0
      then o_orderdate + to_hours(24*((o_orderkey*7)%33)+o_orderkey%24) end order_delivered_customer_date,
    o_orderdate + to_hours(720) order_estimated_delivery_date from orders),
raw_items as (
  select concat('O',cast(l_orderkey as varchar)) order_id, l_linenumber order_item_id,
    concat('S',cast(l_suppkey as varchar)) seller_id, cast(l_extendedprice as decimal(12,2)) price,
    cast(cast(l_extendedprice as decimal(12,2))*cast(l_tax as decimal(4,2)) as decimal(12,2)) freight_value
  from lineitem),
raw_payments as (
  select order_id, 1 payment_sequential, cast(sum(price+freight_value)
    + max(case when cast(substr(order_id,2) as bigint)%40=0 then 5.25 else 0 end) as decimal(22,2)) payment_value
  from raw_items group by order_id),
raw_reviews as (
  select concat('R',cast(l_orderkey as varchar),'-',cast(l_linenumber as varchar)) review_id,
    concat('O',cast(l_orderkey as varchar)) order_id,
    cast(1+(cast(l_quantity as int)+l_orderkey)%5 as int) review_score, l_shipdate review_creation_date,
    case when l_discount>0 then l_returnflag end clean_title,
    case when l_tax>0 then concat(l_returnflag, chr(10), 'said "yes", ', l_linestatus) end clean_message
  from lineitem),
dlv as (
  select *, coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) late
  from raw_orders where order_status='delivered'),
bills as (
  select b.order_id, b.price, b.freight, p.paid, p.paid-b.price-b.freight diff,
    cast(b.freight as double)/nullif(cast(b.price as double),0) fr_ratio
  from (select order_id, sum(price) price, sum(freight_value) freight from raw_items group by order_id) b
  join (select order_id, sum(payment_value) paid from raw_payments group by order_id) p using (order_id)),
first_reviews as (
  select order_id, review_score from (
    select *, row_number() over (partition by order_id
      order by review_creation_date nulls last, review_id, review_score) rn from raw_reviews) where rn=1),
latest_reviews as (
  select review_id, order_id, review_score from (
    select *, row_number() over (partition by review_id
      order by review_creation_date desc nulls last, review_score desc, order_id desc) rn from raw_reviews)
  where rn=1),
impact as (
  select case when late then 'Late' else 'On-time' end late_flag,
    case when review_score<=3 then 'Bad' else 'Good' end sentiment, count(*) orders
  from dlv join latest_reviews using (order_id) group by 1, 2),
sellers as (
  select seller_id, count(*) orders, avg(case when late then 1.0 else 0.0 end) late_rate
  from raw_items join dlv using (order_id) group by seller_id having count(*)>=50),
monthly as (
  select strftime(order_purchase_timestamp,'%Y-%m') ym, count(*) orders,
    sum(case when late then 1 else 0 end) late_orders,
    floor(avg(case when late
      then date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) end)) avg_late_days
  from dlv group by 1)"""

WAREHOUSE = ",".join([DIMENSIONS, ORDERS, SETTLEMENTS, DISCREPANCIES])


def _wk(day: str) -> str:
    """Weeks change on Sunday and carry the Monday after as label."""
    return f"cast(date_trunc('week', {day} + 1) as date)"


# Shared views over the base tables, added where a query needs them.
S_D = "fact_settlements s left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id"
O_D = "fact_orders o left join fact_discrepancies d on d.awb_number=o.awb_number"

SCORE = f"""
score as (
  select c.courier_name, count(*) orders,
    avg(case when o.actual_eta_hrs <= o.promised_eta_hrs then 1.0 else 0.0 end) ontime,
    cast(count(distinct d.awb_number) as double)/nullif(count(distinct o.awb_number),0) dispute,
    avg(case when d.discrepancy_type='PHANTOM_RTO_CHARGE' then 1.0 else 0.0 end) phantom,
    cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs
  from {O_D} join dim_courier c on c.courier_id=o.courier_id group by c.courier_name),
scored as (select *, 0.4::double*ontime + 0.35::double*(1-dispute) + 0.25::double*(1-phantom) reliability from score)"""

CELLS = """
cells as (
  select c.courier_name, g.tier, d.discrepancy_type, count(*) cases, cast(sum(d.variance_rs) as double) leakage_rs
  from fact_discrepancies d join dim_courier c on c.courier_id=d.courier_id
  join dim_geography g on g.geo_id=d.geo_id group by 1, 2, 3)"""

MART = f"""
mart as (
  select s.settlement_date kpi_date, s.courier_id, o.geo_id, count(distinct s.awb_number) orders,
    count(distinct d.awb_number) disputed_awbs, coalesce(sum(d.variance_rs),0) leakage_rs,
    cast(avg(date_diff('day', o.order_date, s.settlement_date)) as decimal(8,2)) avg_dso_days
  from fact_settlements s join fact_orders o on o.awb_number=s.awb_number
  left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id group by 1, 2, 3)"""

SERIES = f"""
series as (
  select wk, leakage_rs, fest, row_number() over (order by wk)-1 t from (
    select {_wk('s.settlement_date')} wk, cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs,
      coalesce(max(cast(dt.is_festival as int)),0) fest
    from {S_D} left join fact_orders o on o.awb_number=s.awb_number
    left join dim_date dt on dt.date_id=o.order_date group by 1)),
centred as (
  select t-avg(t) over () tc, fest-avg(fest) over () fc, leakage_rs-avg(leakage_rs) over () yc,
    t, fest, leakage_rs, wk from series),
sums as (
  select sum(tc*tc)+1 tt, sum(fc*fc)+1 ff, sum(tc*fc) tf, sum(tc*yc) ty, sum(fc*yc) fy, sum(yc*yc) yy,
    avg(t) tm, avg(fest) fm, avg(leakage_rs) ym, count(*) as weeks, max(wk) last_wk from centred),
coefs as (
  select *, (ff*ty-tf*fy)/(tt*ff-tf*tf) coef_t, (tt*fy-tf*ty)/(tt*ff-tf*tf) coef_fest from sums),
fit as (select *, ym-coef_t*tm-coef_fest*fm intercept from coefs),
forecast as (
  select last_wk+cast(7*i as int) wk, round_even(round(intercept+coef_t*(weeks+i-1),9),0) leakage_rs
  from fit, (select unnest([1,2,3,4]) i))"""

_D_OUT = """discrepancy_id, awb_number, batch_id, cast(courier_id as bigint) courier_id, merchant_id,
  cast(geo_id as bigint) geo_id, discrepancy_type, cast(expected_value as double) expected_value,
  cast(actual_value as double) actual_value, cast(variance_rs as double) variance_rs, severity"""

_EVENT_OUT = _D_OUT + ", '2026-01-31 06:30:00.000000' detected_at, discrepancy_id idempotency_key"


def _with(body: str, *views: str) -> str:
    return f"with {','.join([WAREHOUSE, *views])}\n{body}"


def _market(body: str) -> str:
    return f"with {MARKET}\n{body}"


def _chi2(a: str, b: str, c: str, d: str) -> str:
    """Corrected chi-square as the sum over the four cells."""
    n = f"({a}+{b}+{c}+{d})"
    cells = ((a, f"({a}+{b})", f"({a}+{c})"), (b, f"({a}+{b})", f"({b}+{d})"),
             (c, f"({c}+{d})", f"({a}+{c})"), (d, f"({c}+{d})", f"({b}+{d})"))
    terms = []
    for seen, row, column in cells:
        expected = f"({row}*{column}/{n})"
        gap = f"abs({seen}-{expected})"
        terms.append(f"power({gap}-least(0.5,{gap}),2)/{expected}")
    return "round(" + "+".join(terms) + ",6)"


def _cell_list(order: str, limit: int, mean: str, where: str = "true") -> str:
    return f"""select courier_name, tier, discrepancy_type, cases, leakage_rs, {mean}(round(leakage_rs/cases,9), 0) avg_loss
from cells where {where} order by leakage_rs desc, courier_name, tier, discrepancy_type limit {limit}"""


_TREND = """count(*) settlements, count(d.awb_number) disputes,
  cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs"""

_HEADER = f"""
header as (
  select count(distinct s.awb_number) settled_awbs, count(distinct d.awb_number) disputed_awbs,
    cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs,
    avg(cast(date_diff('day', o.order_date, s.settlement_date) as double)) dso
  from {S_D} left join fact_orders o on o.awb_number=s.awb_number)"""

_PCT = "round(round(100.0::double*disputed_awbs/nullif(settled_awbs,0),9),2)"

_SEGMENTS = f"""
m as (
  select o.merchant_id, count(*) orders, cast(sum(o.order_value) as double) gmv,
    cast(sum(coalesce(d.variance_rs,0)) as double) leakage_rs,
    cast(count(d.awb_number) as double)/nullif(count(*),0) dispute_rate
  from {O_D} group by o.merchant_id),
seg as (
  select merchant_id, orders, gmv, leakage_rs, round(round(dispute_rate*100,9),1) dispute_pct,
    cast(ntile(4) over (order by gmv desc, merchant_id) as bigint) value_quartile,
    case when dispute_rate>0.3::double then 'high-risk' when dispute_rate>0.15::double then 'watchlist'
      else 'healthy' end health_band from m)"""

_TIER = f"""
te as (
  select g.tier, count(*) orders, cast(sum(o.order_value) as double) gmv,
    cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs,
    avg(cast(o.actual_eta_hrs-o.promised_eta_hrs as double)) delay
  from fact_orders o join dim_geography g on g.geo_id=o.geo_id
  left join fact_discrepancies d on d.awb_number=o.awb_number group by g.tier)"""

_AWB_D = """
by_awb as (
  select awb_number, count(*) n, sum(variance_rs) v,
    max(case when discrepancy_type='PHANTOM_RTO_CHARGE' then 1 else 0 end) ph
  from fact_discrepancies group by awb_number)"""

_BATCH_D = """
by_pair as (
  select awb_number, batch_id, count(*) n, sum(variance_rs) v from fact_discrepancies group by 1, 2)"""


def _dq() -> str:
    columns = {
        "dim_geography": ("tier", "('Tier-1','Tier-2','Tier-3')"),
        "dim_merchant": ("category", "('Grocery','Food','Pharmacy','D2C')"),
        "fact_orders": ("order_status", "('DELIVERED','RTO','IN_TRANSIT','LOST')"),
    }
    parts = [
        f"select '{t}.{c} in enum' check_name, count(*) filter (where {c} not in {v}) violations from {t}"
        for t, (c, v) in columns.items()
    ]
    parts.append(
        "select 'fact_orders.payment_mode in enum', count(*) filter (where payment_mode not in ('COD','Prepaid'))"
        " from fact_orders"
    )
    required = {
        "dim_courier": "courier_id courier_name base_rate_rs sla_hours",
        "dim_geography": "geo_id city tier zone",
        "dim_merchant": "merchant_id merchant_name category",
        "fact_orders": "order_id awb_number courier_id merchant_id geo_id order_date order_status payment_mode"
        " cod_amount declared_weight order_value promised_eta_hrs",
        "fact_settlements": "settlement_id awb_number batch_id courier_id settlement_date settled_cod"
        " charged_weight forward_charge rto_charge cod_fee",
    }
    column_name = {"base_rate_rs": "courier_id", "zone": "zone_name"}
    for table, names in required.items():
        parts += [
            f"select '{table}.{n} not null', count(*) filter (where {column_name.get(n, n)} is null) from {table}"
            for n in names.split()
        ]
    for table, key in (("dim_courier", "courier_id"), ("dim_courier", "courier_name"), ("dim_geography", "geo_id"),
                       ("dim_merchant", "merchant_id"), ("fact_orders", "order_id"), ("fact_orders", "awb_number"),
                       ("fact_settlements", "settlement_id")):
        parts.append(f"select '{table}.{key} unique', count(*)-count(distinct {key}) from {table}")
    for child, key, parent in (("fact_orders", "courier_id", "dim_courier"),
                               ("fact_orders", "merchant_id", "dim_merchant"),
                               ("fact_orders", "geo_id", "dim_geography"),
                               ("fact_settlements", "courier_id", "dim_courier"),
                               ("fact_settlements", "awb_number", "fact_orders")):
        parts.append(
            f"select '{child}.{key} in {parent}', count(*) from {child} c"
            f" where {key} is not null and not exists (select 1 from {parent} p where p.{key}=c.{key})"
        )
    return "\nunion all ".join(parts)


def _dq_results() -> str:
    found, mart = "fact_discrepancies", "mart"
    required = {
        found: "discrepancy_id awb_number batch_id courier_id merchant_id geo_id discrepancy_type variance_rs severity",
        mart: "kpi_date courier_id geo_id orders disputed_awbs leakage_rs",
    }
    label = {found: found, mart: "fct_daily_kpis"}
    parts = [
        f"select '{label[t]}.{n} not null' check_name, count(*) filter (where {n} is null) violations from {t}"
        for t, names in required.items() for n in names.split()
    ]
    kinds = ",".join(f"'{kind}'" for kind in RULE_SQL)
    parts += [
        f"select '{found}.discrepancy_type in enum', count(*) filter (where discrepancy_type not in ({kinds})) from {found}",
        f"select '{found}.severity in enum', count(*) filter (where severity not in ('HIGH','MEDIUM','LOW')) from {found}",
        f"select '{found}.discrepancy_id unique', count(*)-count(distinct discrepancy_id) from {found}",
        "select 'fct_daily_kpis.kpi_date+courier_id+geo_id unique', count(*)-count(distinct (kpi_date,courier_id,geo_id)) from mart",
    ]
    for child in (found, mart):
        for key, parent in (("courier_id", "dim_courier"), ("merchant_id", "dim_merchant"), ("geo_id", "dim_geography")):
            if (child, key) != (mart, "merchant_id"):
                parts.append(
                    f"select '{label[child]}.{key} in {parent}', count(*) from {child} c"
                    f" where {key} is not null and not exists (select 1 from {parent} p where p.{key}=c.{key})"
                )
    return "\nunion all ".join(parts)


def _measures(filter_d: str = "true", filter_m: str = "true", filter_s: str = "true") -> str:
    return _with(
        f"""select total_leakage, disputed_awbs, settled_awbs,
  round(cast(disputed_awbs as double)/nullif(settled_awbs,0),6) dispute_pct, round(avg_dso,6) avg_dso,
  high_risk_leakage, round(tier3/nullif(total_leakage,0),6) tier3_leakage_pct,
  round(reliability_score,6) reliability_score
from (select cast(sum(variance_rs) as double) total_leakage, count(distinct awb_number) disputed_awbs,
    cast(sum(variance_rs) filter (where severity='HIGH') as double) high_risk_leakage,
    cast(sum(variance_rs) filter (where tier='Tier-3') as double) tier3
  from fact_discrepancies d join dim_courier c on c.courier_id=d.courier_id
  join dim_geography g on g.geo_id=d.geo_id where {filter_d}),
(select cast(sum(orders) as bigint) settled_awbs, avg(cast(avg_dso_days as double)) avg_dso
  from mart k join dim_courier c on c.courier_id=k.courier_id join dim_geography g on g.geo_id=k.geo_id
  where {filter_m}),
(select 0.4::double*avg(ontime)+0.35::double*(1-avg(dispute))+0.25::double*(1-avg(phantom)) reliability_score
  from scored where {filter_s})""",
        MART, SCORE,
    )


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Reconciliation.
    sql["reconcile_rows"] = _with(f"select {_D_OUT} from fact_discrepancies")
    sql["reconcile_summary"] = _with(
        """select discrepancy_type, count(*) cases, cast(sum(variance_rs) as double) leakage_rs
from fact_discrepancies group by 1"""
    )
    for kind in RULE_SQL:
        sql[f"rule_{kind.lower()}"] = _with(f"select {_D_OUT} from fact_discrepancies where discrepancy_type='{kind}'")
    sql["reconcile_one_batch"] = _with(f"select {_D_OUT} from fact_discrepancies where batch_id='RUN-1998'")
    sql["batch_rerun"] = _with(
        """select batch_id, discrepancy_type, count(*) cases, cast(sum(variance_rs) as double) leakage_rs
from fact_discrepancies group by 1, 2"""
    )
    # Two batches lose rows before the other two run again; batches that do not run again keep the copies that there were.
    left = "batch_id<>'RUN-1995' and (batch_id<>'RUN-1996' or courier_id<>1)"
    sql["batch_rerun_changed"] = _with(
        f"""select case batch_id when 'RUN-1996' then '0096' when 'RUN-1997' then '1997-01-06' when 'RUN-1998' then 'श्री 8'
    else batch_id end batch_id, discrepancy_type, count(*) cases, cast(sum(variance_rs) as double) leakage_rs
from (
  select batch_id, discrepancy_type, variance_rs from fact_discrepancies
  where discrepancy_type<>'DUPLICATE_SETTLEMENT' and {left}
  union all
  select batch_id, 'DUPLICATE_SETTLEMENT', settled_cod from (
    select *, count(*) over (partition by awb_number) before,
      count(*) filter (where {left}) over (partition by awb_number) after
    from fact_settlements)
  where {left} and case when batch_id in ('RUN-1996','RUN-1997','RUN-1998') then after else before end > 1)
group by 1, 2"""
    )
    sql["tariff_in_force"] = _with(
        """select s.settlement_id, cast(s.courier_id as bigint) courier_id, cast(s.settlement_date as varchar) settlement_date,
  cast(t.effective_from as varchar) effective_from, cast(t.agreed_rate as double) agreed_rate,
  case when t.agreed_rate is not null then cast(greatest(s.forward_charge - t.agreed_rate, 0) as double) end beyond_rs
from fact_settlements s asof left join (
  select cast(o_orderkey%5+1 as int) courier_id, cast(o_orderdate as date) effective_from,
    cast(max(30+o_orderkey%61) as decimal(10,2)) agreed_rate from orders where o_orderkey%97=0 group by 1, 2) t
on t.courier_id=s.courier_id and t.effective_from<=s.settlement_date"""
    )
    sql["season_kpis"] = _with(
        """select cast(s.courier_id as bigint) courier_id, cast(season_start as varchar) season_start,
  cast(season_end as varchar) season_end, count(*) settlements, cast(sum(n) as bigint) disputes, cast(sum(rs) as double) leakage_rs
from (select distinct cast(o_orderkey%5+1 as int) courier_id, cast(o_orderdate as date)-3 season_start,
    cast(o_orderdate as date) + cast(case when o_orderkey%10=0 then 1500 else o_orderkey%40 end as int) season_end
  from orders where o_orderkey%83=0) z
join (select s.settlement_id, s.courier_id, s.settlement_date, count(d.discrepancy_id) n, coalesce(sum(d.variance_rs),0) rs
  from fact_settlements s left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id group by 1, 2, 3) s
on s.courier_id=z.courier_id and s.settlement_date between season_start and season_end
group by 1, 2, 3"""
    )
    daily = """, daily as (
  select s.courier_id, s.settlement_date as day, count(d.discrepancy_id) disputes, coalesce(sum(d.variance_rs),0) rs
  from fact_settlements s left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id group by 1, 2)"""
    sql["trailing_leakage"] = _with(
        f"""{daily}
select cast(courier_id as bigint) courier_id, cast(day as varchar) as day, disputes, cast(rs as double) leakage_rs,
  cast(sum(disputes) over w as bigint) trailing_disputes, cast(sum(rs) over w as double) trailing_leakage_rs,
  cast(max(rs) over w as double) worst_day_rs
from daily window w as (partition by courier_id order by day range between interval 6 days preceding and current row)"""
    )
    sql["booked_and_settled"] = _with(
        """select cast(coalesce(b.courier_id, s.courier_id) as bigint) courier_id, coalesce(b.m, s.m) as month,
  cast(booked as double) booked_rs, cast(settled as double) settled_rs,
  cast(coalesce(booked,0)-coalesce(settled,0) as double) open_rs
from (select courier_id, strftime(order_date,'%Y-%m') m, sum(cod_amount) booked from fact_orders group by 1, 2) b
full join (select courier_id, strftime(settlement_date,'%Y-%m') m, sum(settled_cod) settled from fact_settlements group by 1, 2) s
on s.courier_id=b.courier_id and s.m=b.m"""
    )
    sql["overdue_intervals"] = _with(
        """select s.settlement_id, s.awb_number, cast(s.settlement_date as varchar) settlement_date,
  cast(s.settled_cod as double) settled_cod, cast(o.order_date+15 as varchar) overdue_from, cast(o.order_date+28 as varchar) overdue_to
from fact_settlements s join fact_orders o on o.awb_number=s.awb_number
  and s.settlement_date between o.order_date+15 and o.order_date+28"""
    )
    sql["attached_trend"] = _with(f"""select cast(s.settlement_date as varchar) kpi_date, {_TREND}
from {S_D} group by 1""")
    sql["unsettled_orders"] = _with(
        """select order_id, awb_number, cast(courier_id as bigint) courier_id, merchant_id,
  cast(order_date as varchar) order_date, order_status from fact_orders o
where not exists (select 1 from fact_settlements s where s.awb_number=o.awb_number)"""
    )
    sql["same_batch_copies"] = _with(
        """select concat('AWB',cast(l_orderkey as varchar)) awb_number, concat('RUN-',cast(year(l_shipdate) as varchar)) batch_id,
  count(*) copies from lineitem group by 1, 2 having count(*)>1"""
    )
    sql["dq_violations"] = _with(_dq())
    sql["dim_date"] = _with(
        f"""select cast(date_id as varchar) date_id, cast({_wk('date_id')} as varchar) week_id,
  strftime(date_id,'%Y-%m') month_id, cast(is_festival as bigint) is_festival from dim_date"""
    )
    sql["load_orders_csv"] = _with(
        """select order_status, payment_mode, count(*) orders, count(actual_eta_hrs) timed,
  cast(sum(cod_amount) as double) cod_amount, cast(sum(declared_weight) as double) declared_weight,
  cast(sum(order_value) as double) order_value, cast(sum(actual_eta_hrs) as double) actual_eta_hrs
from fact_orders group by 1, 2"""
    )
    sql["load_reviews_csv"] = _market(
        """select cast(review_score as bigint) review_score, count(*) reviews, count(distinct order_id) orders,
  count(clean_title) titled, count(clean_message) told, cast(sum(length(clean_message)) as bigint) message_chars
from (select *, row_number() over (partition by review_id order by review_creation_date desc,
  clean_message desc nulls last, clean_title desc nulls last, review_score desc) rn from raw_reviews)
where rn=1 group by 1"""
    )
    sql["load_positional_csv"] = """select cast(r_regionkey+1 as bigint) courier_id, r_name courier_name,
  cast(35+8*r_regionkey as double) base_rate_rs, cast(48+24*(r_regionkey%3) as bigint) sla_hours from region"""
    sql["split_bad_rows_csv"] = """select 'good' kind, count(*) filter (where c_custkey%7<>0) found from customer
union all select 'bad', count(*) filter (where c_custkey%7=0) from customer"""
    sql["calendar_growth"] = _with(
        f"""select cast(date_id as varchar) date_id, cast({_wk('date_id')} as varchar) week_id,
  strftime(date_id,'%Y-%m') month_id, cast(date_diff('day', date_id, case when date_id < date '1996-01-01'
    then date '1996-01-01' else date '2001-08-01' end) between 30 and 37 as bigint) is_festival from dim_date"""
    )
    sql["dq_results"] = _with(_dq_results(), MART)
    sql["analyst_sql"] = _with(
        """select batch_id, severity, count(*) cases, cast(sum(variance_rs) as double) leakage_rs
from fact_discrepancies where discrepancy_type='OVERDUE_REMITTANCE' and variance_rs>1000 group by 1, 2"""
    )
    sql["discrepancy_events"] = _with(f"select {_EVENT_OUT} from fact_discrepancies")
    sql["batch_events"] = _with(f"select {_EVENT_OUT} from fact_discrepancies where batch_id='RUN-1996'")

    # Headline figures and trends.
    sql["header_kpis"] = _with(
        f"select settled_awbs, disputed_awbs, {_PCT} dispute_rate_pct, leakage_rs from header", _HEADER
    )
    sql["header_kpis_dso"] = _with(
        f"""select settled_awbs, disputed_awbs, {_PCT} dispute_rate_pct, leakage_rs, round(round(dso,9),1) avg_dso_days
from header""", _HEADER
    )
    sql["glossary"] = _with(
        f"""select leakage_rs recoverable_leakage_rs, {_PCT} dispute_rate_pct, round(round(dso,9),1) dso_days,
  round(round(leakage_rs/nullif(disputed_awbs,0),9),2) avg_loss_per_disputed_awb from header""", _HEADER
    )
    sql["daily_trend"] = sql["attached_trend"]
    true_trend = """count(*) settlements, cast(coalesce(sum(n),0) as bigint) disputes, cast(coalesce(sum(v),0) as double) leakage_rs
from fact_settlements s left join by_pair p on p.awb_number=s.awb_number and p.batch_id=s.batch_id group by 1"""
    sql["daily_trend_settlement_grain"] = _with(
        f"select cast(s.settlement_date as varchar) kpi_date, {true_trend}", _BATCH_D
    )
    sql["weekly_trend"] = _with(
        f"select cast({_wk('s.settlement_date')} as varchar) wk, {_TREND} from {S_D} group by 1"
    )
    wow = """select cast(wk as varchar) wk, leakage_rs, lag(leakage_rs) over (order by wk) prev_wk,
  round(round(100.0::double*(leakage_rs-lag(leakage_rs) over (order by wk))
    /nullif(lag(leakage_rs) over (order by wk),0),9),1) wow_pct
from (select {week} wk, cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs from {source} group by 1)"""
    sql["weekly_wow"] = _with(wow.format(week=_wk("s.settlement_date"), source=S_D))
    sql["weekly_wow_iso"] = _with(
        wow.format(week="cast(date_trunc('week', s.settlement_date) as date)", source=S_D)
    )
    sql["dso_by_courier"] = _with(
        """select c.courier_name, round(round(avg(cast(date_diff('day', o.order_date, s.settlement_date) as double)),9),1)
    avg_dso_days, quantile_cont(cast(date_diff('day', o.order_date, s.settlement_date) as double), 0.5) p50_dso
from fact_orders o join fact_settlements s on s.awb_number=o.awb_number
join dim_courier c on c.courier_id=o.courier_id group by 1"""
    )
    sql["funnel"] = _with(
        """select cast(step as bigint) step, stage, n, round(round(cast(n as double)/nullif(lag(n) over (order by step),0),9),4) share_of_previous
from (select 1 step, 'Orders' stage, (select count(*) from fact_orders) n
  union all select 2, 'Delivered', (select count(*) from fact_orders where order_status='DELIVERED')
  union all select 3, 'Settled', settled_awbs from header
  union all select 4, 'Matched', settled_awbs-disputed_awbs from header
  union all select 5, 'Disputed', disputed_awbs from header)""", _HEADER
    )
    sql["festival_vs_normal"] = _with(
        """select case when dt.is_festival then 'festival' else 'normal' end period,
  count(distinct s.awb_number) settled, count(d.awb_number) disputes,
  round(round(100.0::double*count(d.awb_number)/nullif(count(distinct s.awb_number),0),9),2) dispute_pct,
  cast(coalesce(sum(d.variance_rs),0) as double) leakage_rs
from fact_settlements s join fact_orders o on o.awb_number=s.awb_number
join dim_date dt on dt.date_id=o.order_date
left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id group by 1"""
    )

    # Scorecards.
    card = """select courier_name, orders, round(round(ontime*100,9),1) ontime_pct, round(round(dispute*100,9),1) dispute_pct,
  round(round(reliability*100,9),1) reliability_score, rank() over (order by reliability desc) reliability_rank, leakage_rs
from {source}"""
    sql["courier_scorecard"] = _with(card.format(source="scored"), SCORE)
    sql["courier_scorecard_order_grain"] = _with(
        card.format(source="""(select *, 0.4::double*ontime+0.35::double*(1-dispute)+0.25::double*(1-phantom)
    reliability from (
  select c.courier_name, count(*) orders, avg(case when actual_eta_hrs<=promised_eta_hrs then 1.0 else 0.0 end) ontime,
    avg(case when b.n is null then 0.0 else 1.0 end) dispute, avg(cast(coalesce(b.ph,0) as double)) phantom,
    cast(coalesce(sum(b.v),0) as double) leakage_rs
  from fact_orders o left join by_awb b on b.awb_number=o.awb_number
  join dim_courier c on c.courier_id=o.courier_id group by 1))"""), _AWB_D
    )
    ranked = """select courier_name, orders, round(ontime,6) ontime, round(dispute,6) dispute,
  round(phantom,6) phantom, leakage_rs, round(reliability,6) reliability,
  cast(floor(rank() over (order by reliability desc) + (count(*) over (partition by reliability)-1)/2.0) as bigint)
    "rank" from (select * replace ({score} as reliability) from scored)"""
    sql["courier_scorecard_frame"] = _with(ranked.format(score="reliability*100"), SCORE)
    sql["scorecard_export"] = _with(ranked.format(score="round_even(round(reliability*100,9),1)"), SCORE)
    sql["dispute_share_by_courier"] = _with(
        "select courier_name, round(100*dispute,6) dispute_pct, leakage_rs from scored", SCORE
    )
    radar = [
        ("Reliability", "round_even(round(reliability*100,9),1)"), ("On-time %", "100*ontime"), ("Clean %", "100*(1-dispute)"),
        ("No-phantom %", "100*(1-phantom)"),
    ]
    names = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    sql["radar"] = _with(
        "\nunion all ".join(f"select '{m}' metric, courier_name, round(round({v},9),1) as value from scored" for m, v in radar), SCORE
    )
    pct_gmv = "round(round(100.0::double*leakage_rs/nullif(gmv,0),9),2) leakage_pct_of_gmv"
    sql["tier_entry"] = _with(
        f"select tier, orders, gmv, leakage_rs, {pct_gmv}, round(round(delay,9),1) avg_delay_hrs from te", _TIER
    )
    sql["tier_entry_export"] = _with("select tier, orders, gmv, leakage_rs, round(delay,6) delay from te", _TIER)
    sql["tier_leakage_share"] = _with(f"select tier, {pct_gmv} from te", _TIER)
    sql["tier_entry_order_grain"] = _with(
        f"""select tier, orders, gmv, leakage_rs, {pct_gmv}, round(round(delay,9),1) avg_delay_hrs from (
  select g.tier, count(*) orders, cast(sum(o.order_value) as double) gmv,
    cast(coalesce(sum(b.v),0) as double) leakage_rs,
    avg(cast(o.actual_eta_hrs-o.promised_eta_hrs as double)) delay
  from fact_orders o join dim_geography g on g.geo_id=o.geo_id left join by_awb b on b.awb_number=o.awb_number
  group by 1)""", _AWB_D
    )

    # Drill-down.
    sql["rca_cells"] = _with(_cell_list("leakage", 20, "round"), CELLS)
    sql["rca_cells_export"] = _with(_cell_list("leakage", 60, "round_even"), CELLS)
    sql["rca_workbench"] = _with(
        """select *, cast(row_number() over (order by leakage_rs desc, courier_name, tier, discrepancy_type)=1
  as bigint) is_top from (""" + _cell_list("leakage", 15, "round_even", "tier='Tier-3'") + ")", CELLS
    )
    sql["rca_workbench_courier"] = _with(
        """select *, cast(row_number() over (order by leakage_rs desc, courier_name, tier, discrepancy_type)=1
  as bigint) is_top from (""" + _cell_list("leakage", 15, "round_even", "courier_name='ASIA'") + ")", CELLS
    )
    sql["rca_rollup"] = _with(
        """select courier_name, tier, discrepancy_type,
  cast(grouping(courier_name, tier, discrepancy_type) as bigint) as level, cast(sum(cases) as bigint) cases,
  round(sum(leakage_rs),6) leakage_rs from cells group by rollup(courier_name, tier, discrepancy_type)""", CELLS
    )
    for name, key in (("type", "discrepancy_type"), ("courier", "courier_name"), ("tier", "tier")):
        sql[f"leakage_by_{name}"] = _with(
            f"""select {key}, cast(sum(cases) as bigint) cases, round(sum(leakage_rs),6) leakage_rs,
  round(sum(leakage_rs)/sum(cases),6) avg_loss from cells group by 1""", CELLS
        )
    sql["average_loss_by_type"] = _with(
        """select discrepancy_type, cast(sum(cases) as bigint) cases, round(sum(leakage_rs),6) leakage_rs,
  round(sum(leakage_rs)/sum(cases),6) avg_loss from cells group by 1 having sum(leakage_rs)>0""", CELLS
    )
    sql["severity_mix"] = _with("select severity, count(*) n from fact_discrepancies group by 1")
    sql["worst_courier_per_tier"] = _with(
        """select tier, courier_name, disputes, leakage_rs,
  rank() over (partition by tier order by leakage_rs desc) tier_rank
from (select tier, courier_name, cast(sum(cases) as bigint) disputes, round(sum(leakage_rs),6) leakage_rs
  from cells group by 1, 2)""", CELLS
    )
    pareto = """select courier_name, cases, leakage_rs, {r}(round(100*(leakage_rs/sum(leakage_rs) over ()),9),1) pct_of_total,
  {r}(round(100*(sum(leakage_rs) over (order by leakage_rs desc, courier_name rows unbounded preceding)
    /sum(leakage_rs) over ()),9),1) running_pct
from (select courier_name, cast(sum(cases) as bigint) cases, round(sum(leakage_rs),6) leakage_rs
  from cells group by 1)"""
    sql["pareto_couriers"] = _with(pareto.format(r="round"), CELLS)
    sql["pareto_export"] = _with(pareto.format(r="round_even"), CELLS)
    sql["treemap"] = _with(
        """select discrepancy_type, tier, courier_name, size, cast(sum(size) over (partition by discrepancy_type)
    as bigint) type_total,
  row_number() over (partition by discrepancy_type order by size desc, tier, courier_name) as "position"
from (select *, cast(floor(leakage_rs+0.5) as bigint) size from cells)""", CELLS
    )
    sql["treemap_nested"] = _with(
        """select discrepancy_type, cast(sum(size) as bigint) type_total,
  string_agg(concat(tier,':',cast(size as varchar)), ',' order by size desc, tier, courier_name) children
from (select *, cast(floor(leakage_rs+0.5) as bigint) size from cells) group by 1""", CELLS
    )
    sql["scatter"] = _with(
        """select discrepancy_type, courier_name, tier, cases x,
  cast(floor(round_even(round(leakage_rs/cases,9),0)+0.5) as bigint) y, cast(floor(leakage_rs+0.5) as bigint) z,
  cast(sum(floor(leakage_rs+0.5)) over (partition by discrepancy_type) as bigint) group_total from cells""", CELLS
    )

    # Lists.
    sql["duplicate_awbs"] = _with(
        """select awb_number, batch_id, courier_name, cast(settlement_date as varchar) settlement_date, rn, cnt
from (select s.awb_number, s.batch_id, c.courier_name, s.settlement_date,
    row_number() over (partition by s.awb_number order by s.settlement_date, s.batch_id, s.settlement_id) rn,
    count(*) over (partition by s.awb_number) cnt
  from fact_settlements s join dim_courier c on c.courier_id=s.courier_id) where cnt>1"""
    )
    sql["overdue_list"] = _with(
        f"""select s.awb_number, s.batch_id, c.courier_name, cast(o.order_date as varchar) order_date,
  cast(s.settlement_date as varchar) settlement_date, {_DAYS} dso_days, cast(s.settled_cod as double) settled_cod
from fact_settlements s join fact_orders o on o.awb_number=s.awb_number
join dim_courier c on c.courier_id=s.courier_id where {_DAYS}>14
order by {_DAYS} desc, s.awb_number, s.batch_id limit 100"""
    )
    sql["cod_short_list"] = _with(
        """select o.awb_number, s.batch_id, c.courier_name, cast(o.cod_amount as double) expected_cod,
  cast(s.settled_cod as double) actual_cod, cast(o.cod_amount-s.settled_cod as double) shortfall_rs
from fact_orders o join fact_settlements s on s.awb_number=o.awb_number
join dim_courier c on c.courier_id=o.courier_id
where o.cod_amount>0 and s.settled_cod < o.cod_amount-least(o.cod_amount*0.02, 10)
order by o.cod_amount-s.settled_cod desc, o.awb_number, s.batch_id limit 100"""
    )
    sql["weight_list"] = _with(
        """select * from (select o.awb_number, s.batch_id, c.courier_name, g.tier,
  cast(o.declared_weight as double) declared_weight, cast(s.charged_weight as double) charged_weight,
  round(round(100.0::double*cast(s.charged_weight-o.declared_weight as double)
    /nullif(cast(o.declared_weight as double),0),9),1) inflate_pct, cast(s.forward_charge as double) forward_charge
from fact_orders o join fact_settlements s on s.awb_number=o.awb_number
join dim_courier c on c.courier_id=o.courier_id join dim_geography g on g.geo_id=o.geo_id
where s.charged_weight > o.declared_weight*1.10) order by inflate_pct desc, awb_number, batch_id limit 100"""
    )
    sql["eta_adherence"] = _with(
        """select c.courier_name, g.tier, count(*) delivered,
  round(round(avg(cast(o.actual_eta_hrs-o.promised_eta_hrs as double)),9),1) avg_delay_hrs,
  round(quantile_cont(cast(o.actual_eta_hrs as double),0.5),6) p50_eta,
  round(quantile_cont(cast(o.actual_eta_hrs as double),0.95),6) p95_eta,
  round(round(100.0::double*sum(case when o.actual_eta_hrs<=o.promised_eta_hrs then 1 else 0 end)/count(*),9),1) sla_met_pct
from fact_orders o join dim_courier c on c.courier_id=o.courier_id join dim_geography g on g.geo_id=o.geo_id
where o.order_status='DELIVERED' and o.actual_eta_hrs is not null group by 1, 2"""
    )

    # Merchants.
    sql["merchant_segments"] = _with("select * from seg order by gmv desc, merchant_id limit 50", _SEGMENTS)
    sql["merchant_quartiles"] = _with("select * from seg", _SEGMENTS)
    sql["merchant_segments_order_grain"] = _with(
        """select merchant_id, orders, gmv, leakage_rs, round(round(rate*100,9),1) dispute_pct,
  cast(ntile(4) over (order by gmv desc, merchant_id) as bigint) value_quartile,
  case when rate>0.3::double then 'high-risk' when rate>0.15::double then 'watchlist' else 'healthy' end health_band
from (select o.merchant_id, count(*) orders, cast(sum(o.order_value) as double) gmv,
    cast(coalesce(sum(b.v),0) as double) leakage_rs, cast(count(b.n) as double)/count(*) rate
  from fact_orders o left join by_awb b on b.awb_number=o.awb_number group by 1)
order by gmv desc, merchant_id limit 50""", _AWB_D
    )
    sql["merchant_health"] = _with(
        """select merchant_id, category, orders, gmv, leakage_rs, round(dispute_rate,6) dispute_rate,
  case when gmv<=q[1] then 'Q4' when gmv<=q[2] then 'Q3' when gmv<=q[3] then 'Q2' else 'Q1' end value_quartile,
  case when dispute_rate<=0.15::double then 'healthy' when dispute_rate<=0.3::double then 'watchlist'
    when dispute_rate<=2.0 then 'high-risk' end health
from m join dim_merchant using (merchant_id), (select quantile_cont(gmv,[0.25,0.5,0.75]) q from m)""", _SEGMENTS
    )
    sql["merchant_retention"] = _with(
        f"""select count(*) disputed_merchants, count(a.merchant_id) retained,
  round(round(100*(cast(count(a.merchant_id) as double)/nullif(count(*),0)),9),2) retention_pct
from (select o.merchant_id, {_wk('min(s.settlement_date)')}+28 wk from fact_discrepancies d
  join fact_settlements s on s.awb_number=d.awb_number and s.batch_id=d.batch_id
  join fact_orders o on o.awb_number=d.awb_number group by 1) f
left join (select distinct merchant_id, {_wk('order_date')} wk from fact_orders) a
  on a.merchant_id=f.merchant_id and a.wk=f.wk"""
    )

    # Mart, exports and measures.
    mart_out = """cast(kpi_date as varchar) kpi_date, cast(courier_id as bigint) courier_id,
  cast(geo_id as bigint) geo_id, orders, disputed_awbs, cast(leakage_rs as double) leakage_rs,
  cast(avg_dso_days as double) avg_dso_days"""
    sql["daily_kpis_mart"] = _with(f"select {mart_out} from mart", MART)
    sql["settlement_cycle"] = sql["daily_kpis_mart"]
    stale = "date '1990-01-01' kpi_date, courier_id, 0 geo_id, 1 orders, 0 disputed_awbs, 0 leakage_rs, 5 avg_dso_days"
    sql["mart_upsert"] = _with(
        f"""select {mart_out} from (select * from mart union all select {stale} from dim_courier)""", MART
    )
    sql["export_kpi_daily"] = _with(
        """select cast(kpi_date as varchar) kpi_date, courier_name, city, tier, orders, disputed_awbs,
  cast(leakage_rs as double) leakage_rs, cast(avg_dso_days as double) avg_dso_days
from mart k join dim_courier c on c.courier_id=k.courier_id join dim_geography g on g.geo_id=k.geo_id""", MART
    )
    sql["export_discrepancies"] = _with(
        """select awb_number, batch_id, courier_name, merchant_id, city, tier, discrepancy_type,
  cast(expected_value as double) expected_value, cast(actual_value as double) actual_value,
  cast(variance_rs as double) variance_rs, severity
from fact_discrepancies d join dim_courier c on c.courier_id=d.courier_id join dim_geography g on g.geo_id=d.geo_id"""
    )
    sql["serving_bundle"] = _with(
        """select 'kpis' export_name, 1 row_count
union all select 'trend', (select count(*) from series) union all select 'pareto', (select count(distinct courier_name) from cells)
union all select 'funnel', 5 union all select 'scorecard', (select count(*) from score)
union all select 'rca_cells', (select least(60, count(*)) from cells)
union all select 'merchants', (select count(distinct merchant_id) from fact_orders)
union all select 'tier_entry', (select count(distinct tier) from cells)
union all select 'forecast', (select count(*)+4 from series)""", CELLS, SCORE, SERIES
    )
    sql["measures_overview"] = _measures()
    sql["measures_sliced"] = _measures(
        "c.courier_name='AMERICA' and g.tier='Tier-3' and d.severity='LOW'",
        "c.courier_name='AMERICA' and g.tier='Tier-3'", "courier_name='AMERICA'",
    )
    sql["leakage_vs_week_before"] = _with(
        """select cast(a.kpi_date as varchar) kpi_date, cast(a.v as double) leakage_rs,
  cast(b.v as double) prev_leakage_rs, round(cast(a.v-b.v as double)/nullif(cast(b.v as double),0),6) as change
from (select kpi_date, sum(leakage_rs) v from mart group by 1) a
left join (select kpi_date, sum(leakage_rs) v from mart group by 1) b on b.kpi_date=a.kpi_date-7""", MART
    )

    # Statistics.
    sql["welch_weight"] = _with(
        """select n_a, n_b, round(m_a,6) mean_a, round(m_b,6) mean_b, round(v_a,6) var_a, round(v_b,6) var_b,
  round((m_a-m_b)/sqrt(v_a/n_a+v_b/n_b),6) t,
  round(round(power(v_a/n_a+v_b/n_b,2)/(power(v_a/n_a,2)/(n_a-1)+power(v_b/n_b,2)/(n_b-1)),9),4) df
from (select count(*) filter (where g) n_a, count(*) filter (where not g) n_b, avg(x) filter (where g) m_a,
    avg(x) filter (where not g) m_b, var_samp(x) filter (where g) v_a, var_samp(x) filter (where not g) v_b
  from (select (cast(s.charged_weight as double)-cast(o.declared_weight as double))
      /cast(o.declared_weight as double)*100 x, c.courier_name='AMERICA' and ge.tier='Tier-3' g
    from fact_orders o join fact_settlements s on s.awb_number=o.awb_number
    join dim_courier c on c.courier_id=o.courier_id join dim_geography ge on ge.geo_id=o.geo_id))"""
    )
    four = _chi2("a", "b", "c", "d")
    sql["chi2_festival"] = _with(
        f"""select cast(a as bigint) fest_disputed, cast(b as bigint) fest_clean, cast(c as bigint) normal_disputed,
  cast(d as bigint) normal_clean, {four} chi2
from (select cast(count(*) filter (where f and x) as double) a, cast(count(*) filter (where f and not x) as double) b,
    cast(count(*) filter (where not f and x) as double) c, cast(count(*) filter (where not f and not x) as double) d
  from (select dt.is_festival f, d.awb_number is not null x from fact_orders o
    join dim_date dt on dt.date_id=o.order_date
    left join (select distinct awb_number from fact_discrepancies) d on d.awb_number=o.awb_number))"""
    )
    sql["chi2_cod_short"] = _with(
        f"""select cast(a as bigint) own_short, cast(b as bigint) own_full, cast(c as bigint) peer_short,
  cast(d as bigint) peer_full, {four} chi2
from (select cast(count(*) filter (where f and x) as double) a, cast(count(*) filter (where f and not x) as double) b,
    cast(count(*) filter (where not f and x) as double) c, cast(count(*) filter (where not f and not x) as double) d
  from (select cu.courier_name='AFRICA' f, d.awb_number is not null x from fact_orders o
    join dim_courier cu on cu.courier_id=o.courier_id
    left join (select distinct awb_number from fact_discrepancies
      where discrepancy_type='COD_SHORT_REMITTANCE') d on d.awb_number=o.awb_number where o.cod_amount>0))"""
    )
    sql["weekly_series"] = _with("select cast(wk as varchar) wk, leakage_rs, cast(fest as bigint) fest, t from series", SERIES)
    sql["ridge_fit"] = _with(
        """select weeks, cast(last_wk as varchar) last_wk, round(intercept,3) intercept, round(coef_t,3) coef_t,
  round(coef_fest,3) coef_fest,
  round(1-(select sum(power(leakage_rs-intercept-coef_t*t-coef_fest*fest,2)) from series, fit)/yy,6) r2 from fit""",
        SERIES,
    )
    sql["ridge_forecast"] = _with("select cast(wk as varchar) wk, leakage_rs from forecast", SERIES)
    sql["actual_and_forecast"] = _with(
        """select cast(wk as varchar) wk, leakage_rs, cast(0 as bigint) as forecast from series
union all select cast(wk as varchar), leakage_rs, 1 from forecast""", SERIES
    )

    # Marketplace.
    sql["late_rate"] = _market(
        """select count(*) delivered, count(*) filter (where late) late_n,
  round(round(cast(count(*) filter (where late) as double)/count(*),9),4) late_rate,
  round(round(avg(case when late then date_diff('second', order_estimated_delivery_date, order_delivered_customer_date)
    /86400.0::double end),9),4) avg_late_days from dlv"""
    )
    sql["payment_mismatch"] = _market(
        """select count(*) billed_orders, count(*) filter (where abs(diff)>1.0) mismatches,
  round(round(cast(count(*) filter (where abs(diff)>1.0) as double)/count(*),9),4) mismatch_rate,
  cast(coalesce(sum(abs(diff)) filter (where abs(diff)>1.0),0) as double) mismatch_value from bills"""
    )
    sql["freight_outliers"] = _market(
        """select round(max(c),6) cut, count(*) filter (where fr_ratio>c) outliers,
  round(avg(fr_ratio) filter (where fr_ratio>c),6) avg_outlier_ratio
from bills, (select quantile_cont(fr_ratio,0.99) c from bills)"""
    )
    first = """first_impact as (
  select cast(count(*) filter (where late and review_score<=3) as double) a,
    cast(count(*) filter (where late and review_score>3) as double) b,
    cast(count(*) filter (where not late and review_score<=3) as double) c,
    cast(count(*) filter (where not late and review_score>3) as double) d
  from dlv join first_reviews using (order_id))"""
    sql["review_impact_first"] = f"""with {MARKET}, {first}
select cast(a as bigint) late_bad, cast(b as bigint) late_good, cast(c as bigint) ontime_bad,
  cast(d as bigint) ontime_good, round(round(a/(a+b),9),4) bad_review_late, round(round(c/(c+d),9),4) bad_review_ontime, {four} chi2
from first_impact"""
    sql["review_impact_latest"] = _market("select * from impact")
    sql["review_pivot"] = _market(
        """select late_flag, cast(coalesce(sum(orders) filter (where sentiment='Bad'),0) as bigint) "Bad",
  cast(coalesce(sum(orders) filter (where sentiment='Good'),0) as bigint) "Good" from impact group by 1"""
    )
    sql["review_mix"] = _market(
        """select concat(late_flag,' · ',sentiment) name, orders as value,
  round(round(100*(cast(orders as double)/(select count(*) from raw_orders)),9),1) share_pct from impact"""
    )
    sql["seller_late"] = _market("select seller_id, orders, round(late_rate,6) late_rate from sellers")
    sql["worst_sellers"] = _market(
        "select seller_id, orders, round(late_rate,6) late_rate from sellers order by 3 desc, 1 limit 10"
    )
    sql["monthly_late"] = _market(
        """select ym, orders, cast(late_orders as bigint) late_orders, cast(avg_late_days as bigint) avg_late_days,
  concat(ym,'-01') as month from monthly"""
    )
    sql["validation_summary"] = f"""with {MARKET}, {first}
select (select count(*) from raw_orders) orders, (select round(round(avg(case when late then 1.0 else 0.0 end),9),4) from dlv)
    late_rate, (select count(*) from dlv where late) late_n,
  (select round(round(cast(count(*) filter (where abs(diff)>1.0) as double)/count(*),9),4) from bills) mismatch_rate,
  (select cast(round(sum(abs(diff)) filter (where abs(diff)>1.0),0) as double) from bills) mismatch_value,
  (select count(*) from bills, (select quantile_cont(fr_ratio,0.99) c from bills) where fr_ratio>c) freight_outliers,
  (select round(round(a/(a+b),9),4) from first_impact) bad_review_late,
  (select round(round(c/(c+d),9),4) from first_impact) bad_review_ontime,
  (select count(*) from sellers) sellers_scored, (select round(round(max(late_rate),9),4) from sellers) worst_seller_late_rate"""
    sql["market_measures"] = _market(
        """select round(late_rate,6) late_rate, round(l,6) bad_rate_late, round(o,6) bad_rate_ontime,
  round(l-o,6) review_lift
from (select cast(sum(late_orders) as double)/sum(orders) late_rate from monthly),
(select cast(sum(orders) filter (where late_flag='Late' and sentiment='Bad') as double)
    /sum(orders) filter (where late_flag='Late') l,
  cast(sum(orders) filter (where late_flag='On-time' and sentiment='Bad') as double)
    /sum(orders) filter (where late_flag='On-time') o from impact)"""
    )

    # Streams, where the result equals a batch.
    per_row = f"select {_D_OUT} from fact_discrepancies where discrepancy_type<>'DUPLICATE_SETTLEMENT'"
    sql["stream_reconcile"] = _with(per_row)
    sql["stream_join"] = _with(per_row)
    sql["stream_duplicates"] = sql["rule_duplicate_settlement"]
    sql["stream_dedup"] = sql["discrepancy_events"]
    sql["event_publication"] = sql["discrepancy_events"]
    # Exports, written and read back.
    sql["whole_run"] = sql["csv_kpi_daily"] = sql["export_kpi_daily"]
    sql["csv_discrepancies"] = sql["export_discrepancies"]
    sql["csv_review_impact"] = sql["review_impact_latest"]
    sql["csv_monthly"] = f"select * exclude (month) from ({sql['monthly_late']})"
    sql["csv_seller_late"] = sql["seller_late"]
    sql["json_trend"] = sql["weekly_trend"]
    sql["json_scorecard"] = sql["scorecard_export"]
    sql["json_rca_cells"] = sql["rca_cells_export"]
    sql["json_kpis"] = sql["header_kpis_dso"]
    sql["json_pareto"] = sql["pareto_export"]
    sql["json_funnel"] = sql["funnel"]
    sql["json_merchants"] = sql["csv_merchant_health"] = sql["merchant_health"]
    sql["json_tier_entry"] = sql["tier_entry_export"]
    sql["json_forecast"] = sql["actual_and_forecast"]
    sql["csv_courier_scorecard"] = sql["scorecard_export"]
    sql["whole_run_results"] = _with(
        f"""select 'events' part, discrepancy_type as name, count(*) found, cast(sum(variance_rs) as double) amount
from fact_discrepancies group by 2
union all select 'summary', discrepancy_type, count(*), cast(sum(variance_rs) as double) from fact_discrepancies group by 2
union all select 'violations', check_name, violations, null from ({_dq()})
union all select 'violations', check_name, violations, null from ({_dq_results()})""", MART
    )
    sql["run_difference"] = _with(
        """, right_run as (select * from fact_discrepancies where batch_id='RUN-1996'),
before_run as (
  select * replace (cast(case when courier_id=2 then variance_rs+10 else variance_rs end as decimal(12,2)) as variance_rs)
  from right_run where courier_id<>1
  union all select * from right_run where courier_id=3),
gained as (select *, count(*) times from (select * from right_run except all select * from before_run) group by all),
lost as (select *, count(*) times from (select * from before_run except all select * from right_run) group by all),
apart as (select *, 'gained' side from gained union all select *, 'lost' side from lost)
select discrepancy_id, awb_number, batch_id, cast(courier_id as bigint) courier_id, merchant_id, cast(geo_id as bigint) geo_id,
  discrepancy_type, cast(expected_value as double) expected_value, cast(actual_value as double) actual_value,
  cast(variance_rs as double) variance_rs, severity, times,
  case when count(distinct side) over (partition by discrepancy_id)=1 then side
    when side='gained' then 'changed_to' else 'changed_from' end as change from apart"""
    )
    dims = "courier_name, tier, discrepancy_type, severity"
    sql["discrepancy_cube"] = _with(
        f"""select cast(grouping({dims}) as bigint) grouping_id, {dims}, count(*) cases, count(distinct awb_number) awbs,
  cast(sum(variance_rs) as double) leakage_rs
from fact_discrepancies d join dim_courier c on c.courier_id=d.courier_id join dim_geography g on g.geo_id=d.geo_id
group by cube ({dims})"""
    )
    sql["sketch_check"] = _with(
        """select cast(s.courier_id as bigint) courier_id, count(distinct s.awb_number) exact_awbs,
  count(distinct d.awb_number) exact_disputed, cast(1 as bigint) awbs_near, cast(1 as bigint) disputed_near, cast(1 as bigint) median_near
from fact_settlements s left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id
where s.settlement_date between date '1994-03-01' and date '1997-10-31' group by 1"""
    )
    sql["stream_bursts"] = _with(
        """, rows_of as (
  select s.courier_id, o.geo_id, s.settlement_date, s.settlement_id, count(*) n, sum(d.variance_rs) rs
  from fact_settlements s join fact_orders o on o.awb_number=s.awb_number
  join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id
  group by 1, 2, 3, 4 having sum(d.variance_rs)>=5000),
marked as (
  select *, case when settlement_date - lag(settlement_date) over w <= 5 then 0 else 1 end starts
  from rows_of window w as (partition by courier_id, geo_id order by settlement_date)),
numbered as (
  select *, sum(starts) over (partition by courier_id, geo_id order by settlement_date, starts desc rows unbounded preceding) burst
  from marked)
select cast(courier_id as bigint) courier_id, cast(geo_id as bigint) geo_id, cast(min(settlement_date) as varchar) burst_start,
  cast(max(settlement_date) as varchar) burst_end, count(*) settlements, cast(sum(n) as bigint) disputes, cast(sum(rs) as double) leakage_rs
from numbered group by courier_id, geo_id, burst"""
    )

    sql["stream_daily"] = sql["daily_trend"]
    sql["stream_weekly"] = sql["weekly_trend"]
    sql["stream_sliding"] = _with(
        """, joined as (
  select s.settlement_date, d.awb_number disputed, d.variance_rs
  from fact_settlements s left join fact_discrepancies d on d.awb_number=s.awb_number and d.batch_id=s.batch_id)
select cast(span_start as varchar) span_start, count(*) settlements, count(disputed) disputes,
  cast(coalesce(sum(variance_rs),0) as double) leakage_rs
from (select *, unnest([sunday - 21, sunday - 14, sunday - 7, sunday]) span_start
  from (select *, settlement_date - cast(dayofweek(settlement_date) as int) sunday from joined))
group by 1"""
    )
    return sql

"""The SQL form of every query, over the same tables, for an independent engine."""

from __future__ import annotations

# The five tables.
ORDERS = """
orders_t as (
  select o_orderkey as order_id, o_custkey as customer_id,
         case o_orderstatus when 'F' then 'DELIVERED' when 'O' then 'PENDING' else 'PROCESSING' end as order_status,
         cast(o_totalprice as decimal(12,2)) as total_amount,
         case o_orderpriority when '1-URGENT' then 'latency_test_' || o_orderkey
                              when '2-HIGH' then 'batch_' || o_orderkey
                              when '3-MEDIUM' then 'bench_addr_' || o_orderkey
                              when '5-LOW' then 'unlimited_addr_' || o_orderkey end as shipping_address,
         o_orderdate as created_at, o_orderdate as updated_at
  from orders)"""
CUSTOMERS = """
customers_t as (
  select c_custkey as customer_id, 'Customer' as first_name, c_name as last_name,
         case c_mktsegment when 'AUTOMOBILE' then 'test_' || c_custkey || '@example.com'
                           when 'BUILDING' then 'load_' || c_custkey || '@example.com'
                           when 'FURNITURE' then 'unlimited_' || c_custkey || '@example.com'
                           when 'HOUSEHOLD' then 'bench_' || c_custkey || '@example.com'
                           else 'user' || c_custkey || '@email.com' end as email,
         '555-' || lpad(cast(c_nationkey as varchar), 4, '0') as phone,
         cast(date '2023-01-01' + c_nationkey as date) as registration_date,
         c_mktsegment as customer_tier, cast(0 as integer) as total_orders,
         cast(c_acctbal as decimal(14,2)) as total_spent,
         timestamp '2024-01-01 00:00:00' as created_at, timestamp '2024-01-01 00:00:00' as updated_at
  from customer)"""
PRODUCTS = """
products_t as (
  select p_partkey as product_id,
         case p_type when 'ECONOMY' then 'SKU_' || p_partkey when 'LARGE' then 'LOAD_' || p_partkey
                     when 'MEDIUM' then 'UNLIM_' || p_partkey when 'PROMO' then 'BENCH_' || p_partkey
                     else 'ITEM-' || p_partkey end as sku,
         p_name as product_name, p_type as category, cast(p_retailprice as decimal(10,2)) as price,
         p_size as stock_quantity, true as is_active,
         timestamp '2024-01-01 00:00:00' as created_at, timestamp '2024-01-01 00:00:00' as updated_at
  from part)"""
ITEMS = """
items_t as (
  select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id, l_suppkey as supplier_id,
         cast(l_quantity as integer) as quantity, cast(l_extendedprice as decimal(10,2)) as unit_price,
         cast(cast(l_quantity as integer) * cast(l_extendedprice as decimal(10,2)) as decimal(12,2)) as total_price,
         l_shipdate as created_at
  from lineitem)"""
MOVEMENTS = """
movements_t as (
  select event_id as movement_id, user_id as product_id,
         case event_type when 'click' then 'IN' when 'view' then 'ADJUSTMENT' when 'purchase' then 'OUT'
                         when 'signup' then 'RETURN' else 'PROBE' end as movement_type,
         cast(floor(value) as integer) as quantity, cast(null as bigint) as reference_id,
         case event_type when 'click' then 'Test movement ' || event_id when 'view' then 'Load test ' || event_id
                         when 'purchase' then 'Unlimited test ' || event_id
                         when 'signup' then 'Benchmark movement ' || event_id end as notes,
         ts as created_at
  from events)"""

# Their feeds, and the rows the feeds lead to.
ORDER_LOG = """
order_log as (
  select case when l_returnflag = 'R' then 'd' else 'u' end as op,
         (cast(date_diff('day', date '1992-01-01', cast(l_shipdate as date)) as bigint) * 8 + l_linenumber)
           * 1099511627776 + l_partkey as seq,
         l_orderkey as order_id,
         case when l_returnflag <> 'R' then l_suppkey end as customer_id,
         case when l_returnflag <> 'R' then case l_linestatus when 'O' then 'SHIPPED' else 'DELIVERED' end end
           as order_status,
         case when l_returnflag <> 'R' then cast(l_extendedprice as decimal(12,2)) end as total_amount,
         case when l_returnflag <> 'R' then 'load_addr_' || l_partkey end as shipping_address,
         case when l_returnflag <> 'R' then l_shipdate end as created_at,
         case when l_returnflag <> 'R' then l_shipdate end as updated_at
  from lineitem)"""
ORDER_FEED = (
    ORDERS
    + ","
    + ORDER_LOG
    + """,
order_feed as (
  select 'r' as op, cast(0 as bigint) as seq, * from orders_t
  union all select * from order_log)"""
)
ORDER_STATE = (
    ORDER_FEED
    + """,
order_state as (
  select * from order_feed
  qualify row_number() over (partition by order_id order by seq desc, op desc, customer_id desc nulls last,
    order_status desc nulls last, total_amount desc nulls last, shipping_address desc nulls last,
    created_at desc nulls last, updated_at desc nulls last) = 1),
orders_now as (select * exclude (op, seq) from order_state where op <> 'd')"""
)
CUSTOMER_FEED = (
    CUSTOMERS
    + """,
customer_feed as (
  select 'r' as op, cast(0 as bigint) as seq, * from customers_t
  union all
  select 'u', cast(date_diff('day', date '1992-01-01', cast(o_orderdate as date)) as bigint) * 1099511627776
           + o_orderkey, o_custkey, 'Customer',
         cast(o_custkey as varchar), 'user' || o_custkey || '@email.com', null, cast(o_orderdate as date),
         case o_orderpriority when '1-URGENT' then 'PLATINUM' when '2-HIGH' then 'GOLD' when '3-MEDIUM' then 'SILVER'
                              when '5-LOW' then 'BRONZE' end,
         cast(1 as integer), cast(o_totalprice as decimal(14,2)), o_orderdate, o_orderdate
  from orders
  union all
  select 'd', cast(3000 as bigint) * 1099511627776, c_custkey, null, null, null, null, null, null, null, null, null, null
  from customer where c_acctbal < 0)"""
)
CUSTOMER_STATE = (
    CUSTOMER_FEED
    + """,
customers_now as (
  select * exclude (op, seq) from (
    select * from customer_feed
    qualify row_number() over (partition by customer_id order by seq desc, op desc, first_name desc nulls last,
      last_name desc nulls last, email desc nulls last, phone desc nulls last, registration_date desc nulls last,
      customer_tier desc nulls last, total_orders desc nulls last, total_spent desc nulls last) = 1)
  where op <> 'd')"""
)
PRODUCT_STATE = (
    PRODUCTS
    + """,
product_state as (
  select product_id, case when stock_quantity > 25 then 'u' else 'r' end as op,
         case when stock_quantity > 25 then cast(price * 1.10 as decimal(10,2)) else price end as price,
         stock_quantity, stock_quantity <= 25 as is_active
  from products_t where category <> 'PROMO')"""
)
PROBES = """
probes_t as (
  select event_id as probe_seq,
         case event_type when 'click' then 'orders' when 'view' then 'customers' when 'purchase' then 'products'
                         when 'signup' then 'order_items' else 'inventory_movements' end as "table",
         'probe_' || event_id as marker, ts,
         cast(round(value * 100) as bigint) as ms,
         case when round(value * 100) >= 30000 then cast(-1 as bigint) else cast(round(value * 100) as bigint) end
           as latency_ms
  from events)"""
LAST_100 = (
    PROBES
    + """,
last_100 as (
  select probe_seq, "table", latency_ms from probes_t where latency_ms >= 0
  qualify row_number() over (partition by "table" order by probe_seq desc) <= 100)"""
)
TABLE_NAMES = "(values ('orders'), ('customers'), ('products'), ('order_items'), ('inventory_movements')) as n(\"table\")"


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _stats(rows: str, percents: tuple[int, ...]) -> str:
    """Floor-rank statistics per table of ``rows``, 0 where a table has none."""
    picks = ", ".join(f"coalesce(list_sort(v)[least(n * {p} // 100, n - 1) + 1], 0) as p{p}_ms" for p in percents)
    return f"""
select n."table", cast(coalesce(n, 0) as bigint) as n,
       coalesce(cast(s as double) / cast(n as double), 0.0) as avg_ms,
       coalesce(lo, 0) as min_ms, coalesce(hi, 0) as max_ms, {picks}
from {TABLE_NAMES} left join (
  select "table", count(*) as n, cast(sum(latency_ms) as bigint) as s, min(latency_ms) as lo, max(latency_ms) as hi,
         list(latency_ms) as v
  from {rows} where latency_ms >= 0 group by 1) g on g."table" = n."table\""""


def _overall(rows: str, p: int) -> str:
    return f"""
select n, cast(s as double) / cast(n as double) as avg_ms, lo as min_ms, hi as max_ms,
       list_sort(v)[least(n * {p} // 100, n - 1) + 1] as p{p}_ms
from (select count(*) as n, cast(sum(latency_ms) as bigint) as s, min(latency_ms) as lo, max(latency_ms) as hi,
             list(latency_ms) as v from {rows} where latency_ms >= 0)"""


def _draw(salt: str, bound: int | str, row: str = "i") -> str:
    return f"(cast('0x' || substr(md5('{salt}:' || {row}), 1, 8) as bigint) % {bound})"


def _letters(salt: str, n: int) -> str:
    return f"translate(substr(md5('{salt}:' || i), 1, {n}), '0123456789', 'ghijklmnop')"


def _cents(salt: str, low: int, high: int, precision: int = 10) -> str:
    """Whole cents as an amount, digit by digit: no binary fraction takes part."""
    cents = f"({_draw(salt, high - low + 1)} + {low})"
    return f"cast(({cents} // 100) || '.' || lpad(cast({cents} % 100 as varchar), 2, '0') as decimal({precision},2))"


def _pick(words: list[str], index: str) -> str:
    return "([" + ", ".join(f"'{w}'" for w in words) + f"])[cast({index} + 1 as integer)]"


def _pool(source: str, key: str, out: str, size: int) -> str:
    return f"""
{out}_pool as (
  select {key} as {out}, row_number() over (order by {key}) - 1 as place, count(*) over () - 1 as last
  from (select {key} from {source} order by {key} limit {size}))"""


NUMBERS = "numbers as (select row_number() over (order by c_custkey) as i from customer)"
DAILY = """
select cast(created_at as date) as order_date, count(*) as total_orders,
       cast(sum(total_amount) as decimal(38,2)) as total_revenue,
       cast(sum(total_amount) as double) / cast(count(*) as double) as avg_order_value,
       count(distinct customer_id) as unique_customers
from orders_now group by 1"""
TIERS = """
select customer_tier, count(*) as customer_count, cast(sum(total_orders) as bigint) as total_orders,
       cast(sum(total_spent) as decimal(38,2)) as total_revenue,
       cast(sum(total_spent) as double) / cast(count(total_spent) as double) as avg_customer_value
from customers_now group by 1"""

ALL_TABLES = (ORDERS, CUSTOMERS, PRODUCTS, ITEMS, MOVEMENTS)
REPORT = (
    _with(
        ORDER_STATE,
        CUSTOMER_STATE,
        """
counts as (
  select 'orders' as "table", (select count(*) from orders) as source_count,
         (select count(*) from orders_now) as target_count
  union all select 'customers', (select count(*) from customer), (select count(*) from customers_now)
  union all select 'products', (select count(*) from part), (select count(*) from part where p_type <> 'PROMO')
  union all select 'order_items', (select count(*) from lineitem),
         (select count(*) from (select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem group by all
                                having bool_and(l_returnflag <> 'R')))
  union all select 'inventory_movements', (select count(*) from events), (select count(*) from events)),
report as (
  select "table", source_count, target_count, source_count - target_count as lag,
         case when source_count > target_count then '+' else '' end || (source_count - target_count) as lag_label,
         case when source_count = target_count then 'SYNCED' else 'LAGGING' end as status
  from counts)""",
    )
)


def _verdict(fine: str) -> str:
    return f"""{REPORT}
select count(*) as tables, cast(0 as bigint) as unknown, bool_and({fine}) as synced,
       cast(sum(abs(lag)) as bigint) as total_lag,
       case when bool_and({fine}) then 'ALL SYNCED' else 'TOTAL LAG: ' || cast(sum(abs(lag)) as bigint) end as verdict
from report"""


STATUS_IN = (
    "('TEST', 'BATCH', 'TO_DELETE', 'CONTINUOUS', 'MULTI_TEST', 'PENDING', 'PROCESSING', 'SHIPPED', 'DELIVERED')"
)
ITEM_ADDRESS = """(shipping_address like 'latency_test_%' or shipping_address like 'batch_%'
  or shipping_address like 'delete_test_%' or shipping_address like 'continuous_%'
  or shipping_address like 'multi_addr_%' or shipping_address like 'load_addr_%')"""
ORDER_ADDRESS = f"({ITEM_ADDRESS} or shipping_address like 'unlimited_addr_%')"
TEST_ORDERS = f"order_status in {STATUS_IN} and {ORDER_ADDRESS}"
TEST_PARENTS = f"order_status in {STATUS_IN} and {ITEM_ADDRESS}"
ITEM_KEYS = "order_id, line_number, product_id, supplier_id"


def _label(name: str, expression: str) -> str:
    return f"{_with(PROBES)} select probe_seq, {expression} as {name} from probes_t"


MONITOR = (
    REPORT
    + ","
    + LAST_100
    + f""",
newest as (select "table", arg_max(latency_ms, probe_seq) as last_ms from probes_t group by 1),
stats as ({_stats("last_100", (95,))}),
monitor as (
  select c."table", source_count, target_count, source_count - target_count as lag,
         coalesce(last_ms, 0) as last_latency_ms, avg_ms as avg_latency_ms, p95_ms as p95_latency_ms
  from counts c join stats s on s."table" = c."table" left join newest n on n."table" = c."table")"""
)
SECONDS_LABEL = """case when {0} < 0 then 'TIMEOUT' when {0} < 1000 then {0} || 'ms'
  else (({0} + 5) // 1000) || '.' || lpad(cast(({0} + 5) // 10 % 100 as varchar), 2, '0') || 's' end"""
STATUS_LABEL = """case when {0} < 0 or {0} >= 10000 then 'CRIT'
  when {0} > 0 and {0} < 5000 then 'OK' else 'WARN' end"""

ORACLE: dict[str, str] = {
    "monitor_report": f"""{MONITOR}
select *, {SECONDS_LABEL.format("last_latency_ms")} as latency_label,
       case when last_latency_ms <> 0 then {STATUS_LABEL.format("last_latency_ms")} end as status
from monitor""",
    "check_report": f"""{MONITOR}
select m."table", last_ms as latency_ms, source_count, target_count, lag,
       case when last_ms <= 0 then 'FAIL' when last_ms < 5000 then 'OK' else 'WARN' end as status
from monitor m join newest n on n."table" = m."table\"""",
    "monitor_json": f"""{MONITOR}
select '2024-01-01T00:00:00' as timestamp, (select count(*) from events) as total_probes,
       (select count(*) from probes_t where latency_ms >= 0) as successful_probes,
       (select count(*) from probes_t where latency_ms < 0) as failed_probes,
       "table", source_count, target_count, lag, last_latency_ms, avg_latency_ms, p95_latency_ms
from monitor""",
    "snapshot_scan": f"{_with(ORDERS)} select 'r' as op, cast(0 as bigint) as seq, * from orders_t",
    "change_scan": f"{_with(ORDER_FEED)} select * from order_feed",
    "snapshot_plus_changes": f"{_with(ORDER_STATE)} select * from orders_now",
    "current_scan": f"{_with(ORDER_STATE)} select * from orders_now",
    "upsert_latest": f"{_with(ORDER_STATE)} select * from order_state",
    "apply_deletes": f"""{_with(ITEMS)} select * from items_t where ({ITEM_KEYS}) not in
  (select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where l_returnflag = 'R')
qualify row_number() over (partition by {ITEM_KEYS}
  order by quantity desc, unit_price desc, total_price desc, created_at desc) = 1""",
    "apply_updates": f"""{_with(PRODUCT_STATE)}
select product_id, price, stock_quantity, is_active from product_state where op = 'u'""",
    "replay_idempotent": f"{_with(ORDER_STATE)} select * from orders_now",
    "late_and_duplicate": f"{_with(ORDER_STATE)} select * from orders_now",
    "key_change": f"""{_with(ITEMS)},
parts as (
  select 'd' as op, product_id, cast(null as integer) as quantity from items_t where product_id <> supplier_id
  union all select 'c', supplier_id, quantity from items_t where product_id <> supplier_id
  union all select 'u', product_id, quantity from items_t where product_id = supplier_id)
select op, product_id, count(*) as events, cast(sum(quantity) as bigint) as quantity from parts group by all""",
    "contract_violations": """
select movement_id, reasons from (
  select doc_id as movement_id,
         concat_ws('; ', case when quality is null then 'product_id: null' end,
                   case when source is null then 'movement_type: null' end,
                   case when strlen(source) > 20 then 'movement_type: longer than 20' end,
                   case when n_chars is null then 'quantity: null' end,
                   case when strlen(text) > 500 then 'notes: longer than 500' end) as reasons
  from documents left join labels using (doc_id))
where reasons <> ''""",
    "project_keys": "select c_custkey as customer_id from customer",
    "marker_equals": f"{_with(CUSTOMERS)} select * from customers_t where last_name = 'Customer#000000007'",
    "marker_prefix": f"{_with(ORDERS)} select * from orders_t where shipping_address like 'batch_%'",
    "marker_affix": f"""{_with(CUSTOMERS)}
select customer_id, email from customers_t where email like 'test_%@example.com'""",
    "status_in": f"{_with(ORDERS)} select * from orders_t where order_status in ('PENDING', 'SHIPPED', 'DELIVERED')",
    "cleanup_predicate": f"{_with(ORDERS)} select * from orders_t where {TEST_ORDERS}",
    "line_totals": f"{_with(ITEMS)} select {ITEM_KEYS}, total_price as line_total from items_t",
    "fill_defaults": f"""{_with(CUSTOMERS)}
select customer_id, 'PENDING' as order_status, cast(0.00 as decimal(12,2)) as total_amount, email as shipping_address,
       timestamp '2024-01-01 00:00:00' as created_at, timestamp '2024-01-01 00:00:00' as updated_at
from customers_t""",
    "delete_by_join": f"""{_with(ORDERS, ITEMS)}
select 'd' as op, cast(10 as bigint) as seq, {ITEM_KEYS} from items_t
where order_id in (select order_id from orders_t where {TEST_PARENTS})""",
    "delete_by_subquery": f"""{_with(ORDERS, ITEMS)}
select 'd' as op, cast(10 as bigint) as seq, {ITEM_KEYS} from items_t
where order_id in (select order_id from orders_t where shipping_address like 'bench_addr_%')""",
    "fk_orphans": f"""{_with(ORDER_STATE, ITEMS)}
select {ITEM_KEYS}, total_price from items_t where order_id not in (select order_id from orders_now)""",
    "content_differences": f"""{_with(ORDER_STATE)}
select order_id, 'missing' as kind from orders_now where order_id % 101 = 5
union all select order_id, 'changed' from orders_now where order_id % 101 <> 5 and order_id % 97 in (3, 4) and total_amount is not null
union all select -o_orderkey, 'extra' from orders where o_orderkey % 103 = 7""",
    "orphans_current": f"""{_with(ORDER_STATE)},
items_now as (select l_orderkey from lineitem group by l_orderkey, l_linenumber, l_partkey, l_suppkey having bool_and(l_returnflag <> 'R'))
select l_orderkey as order_id, count(*) as n_items from items_now
where l_orderkey not in (select order_id from orders_now) group by 1""",
    "cascade_delete": f"""{_with(ORDERS, ITEMS)}
select 'd' as op, cast(11 as bigint) as seq, {ITEM_KEYS} from items_t
where order_id in (select order_id from orders_t where {TEST_ORDERS})""",
    "restrict_delete": f"""{_with(PRODUCTS, ITEMS)}
select product_id, sku, product_id not in (select l_partkey from (
  select l_partkey from lineitem group by l_orderkey, l_linenumber, l_partkey, l_suppkey
  having bool_and(l_returnflag <> 'R'))) as allowed
from products_t where sku like 'SKU_%' or sku like 'LOAD_%' or sku like 'UNLIM_%'""",
    "table_counts": """
select 'orders' as "table", count(*) as row_count from orders
union all select 'customers', count(*) from customer
union all select 'products', count(*) from part
union all select 'order_items', count(*) from lineitem
union all select 'inventory_movements', count(*) from events""",
    "marker_count": f"""{_with(*ALL_TABLES)}
select 'orders' as "table", count(*) as row_count from orders_t where shipping_address like 'batch_%'
union all select 'customers', count(*) from customers_t where email like 'test_%@example.com'
union all select 'products', count(*) from products_t where sku like 'SKU_%'
union all select 'inventory_movements', count(*) from movements_t where notes like 'Test movement %'""",
    "sync_report": f"{REPORT} select * from report",
    "fanout_apply": f"{REPORT} select *, true as same_content from report",
    "sync_exact": _verdict("lag = 0"),
    "sync_at_least": _verdict("lag <= 0"),
    "report_json": f"""{REPORT}
select '{{"table":"' || "table" || '","source_count":' || source_count || ',"target_count":' || target_count ||
       ',"lag":' || lag || ',"status":"' || status || '"}}' as line from report""",
    "lag_labels": f"""{_with(PRODUCTS, ITEMS)},
sold as (select product_id, cast(sum(quantity) as bigint) as sold from items_t group by 1),
lags as (select product_id, stock_quantity - coalesce(sold, 0) as lag from products_t left join sold using (product_id))
select product_id, case when lag > 0 then '+' else '' end || lag as label from lags""",
    "daily_order_summary": _with(ORDER_STATE) + DAILY,
    "view_incremental": _with(ORDER_STATE) + DAILY,
    "customer_tier_summary": _with(CUSTOMER_STATE) + TIERS,
    "tier_view_incremental": _with(CUSTOMER_STATE) + TIERS,
    "probe_latency": f"""{_with(PROBES)}
select probe_seq, "table", marker, latency_ms, latency_ms >= 0 as success from probes_t""",
    "latency_stats": _with(PROBES) + _stats("probes_t", (95, 99)),
    "latency_p95": f"select \"table\", p95_ms from ({_with(LAST_100) + _stats('last_100', (95,))})",
    "latency_p99": _with(PROBES) + _overall("probes_t", 99),
    "latency_last100": f"{_with(LAST_100)} select * from last_100",
    "latency_overall": _with(LAST_100) + _overall("last_100", 95),
    "latency_running": f"""{_with(PROBES)},
numbered as (
  select probe_seq, "table", latency_ms,
         count(*) filter (where latency_ms >= 0) over (partition by "table" order by probe_seq
           rows between unbounded preceding and current row) as k
  from probes_t),
framed as (
  select probe_seq, "table", latency_ms,
         list(latency_ms) filter (where latency_ms >= 0) over (partition by "table" order by k
           range between 99 preceding and current row) as v
  from numbered)
select probe_seq, "table", latency_ms as last_ms, cast(coalesce(len(v), 0) as bigint) as n,
       coalesce(cast(list_sum(v) as double) / cast(len(v) as double), 0.0) as avg_ms,
       coalesce(list_sort(v)[least(len(v) * 95 // 100, len(v) - 1) + 1], 0) as p95_ms
from framed""",
    "latency_last": f"""{_with(PROBES)}
select n."table", coalesce(last_ms, 0) as last_ms from {TABLE_NAMES}
left join (select "table", arg_max(latency_ms, probe_seq) as last_ms from probes_t group by 1) g
  on g."table" = n."table\"""",
    "probe_success": f"""{_with(PROBES)}
select count(*) as total_probes, count(*) filter (where latency_ms >= 0) as successful_probes,
       count(*) filter (where latency_ms < 0) as failed_probes,
       cast(count(*) filter (where latency_ms >= 0) as double) / cast(count(*) as double) * 100 as success_rate
from probes_t""",
    "latency_label": _label(
        "latency_label",
        SECONDS_LABEL.format("latency_ms"),
    ),
    "latency_color": _label(
        "latency_color",
        """case when latency_ms < 0 then 'red' when latency_ms < 2000 then 'green'
  when latency_ms < 5000 then 'yellow' else 'red' end""",
    ),
    "latency_status": _label(
        "latency_status",
        STATUS_LABEL.format("latency_ms"),
    ),
    "check_status": _label(
        "check_status",
        "case when latency_ms <= 0 then 'FAIL' when latency_ms < 5000 then 'OK' else 'WARN' end",
    ),
    "load_summary": f"""{_with(PROBES)},
per_table as (
  select "table", count(*) filter (where ms < 30000) as inserts, count(*) filter (where ms >= 30000) as errors
  from probes_t group by 1)
select * from per_table
union all select 'TOTAL', cast(sum(inserts) as bigint), cast(sum(errors) as bigint) from per_table""",
    "throughput": f"""{_with(PROBES)},
spans as (
  select "table", count(*) filter (where ms < 30000) as inserts,
         date_sub('microsecond', min(ts), max(ts)) // 1000 as duration_ms
  from probes_t group by 1)
select "table", inserts, duration_ms,
       case when duration_ms <= 0 then 0.0 else cast(inserts * 1000 as double) / cast(duration_ms as double) end
         as per_sec,
       cast(case when duration_ms <= 0 then '0.00' else
         (inserts * 100000 // duration_ms // 100) || '.' ||
         lpad(cast(inserts * 100000 // duration_ms % 100 as varchar), 2, '0') end as decimal(18,2)) as per_sec_cut
from spans""",
    "latest_orders": f"{_with(ORDERS)} select * from orders_t order by order_id desc limit 5",
    "id_pool": "select p_partkey as product_id from part order by 1 limit 100",
    "insert_events": f"""{_with(CUSTOMERS)}
select 'c' as op, cast(7 as bigint) as seq, true as no_before, * from customers_t""",
    "assign_keys": """
select (select max(o_orderkey) from orders) + row_number() over (order by c_custkey) as order_id,
       c_custkey as customer_id from customer""",
    "update_events": f"""{_with(ORDERS)}
select 'u' as op, cast(8 as bigint) as seq, order_id, order_status as before_order_status,
       updated_at as before_updated_at, 'SHIPPED' as after_order_status,
       timestamp '2024-01-01 00:00:00' as after_updated_at
from orders_t where order_status <> 'DELIVERED' and order_status <> 'SHIPPED'""",
    "delete_events": f"""{_with(MOVEMENTS)}
select 'd' as op, cast(9 as bigint) as seq, movement_id, notes from movements_t
where notes like 'Test movement %' or notes like 'Load test %' or notes like 'Unlimited test %'""",
    "cleanup_all": f"""{_with(*ALL_TABLES)},
items_left as (
  select distinct {ITEM_KEYS} from items_t where order_id not in (
    select order_id from orders_t where {TEST_ORDERS} or shipping_address like 'bench_addr_%'))
select 'orders' as "table", count(*) as remaining from orders_t
where not coalesce({TEST_ORDERS} or shipping_address like 'bench_addr_%', false)
union all select 'customers', count(*) from customers_t
where not (email like 'test_%@example.com' or email like 'load_%@example.com' or email like 'unlimited_%@example.com'
           or email like 'bench_%')
union all select 'products', count(*) from products_t
where not (sku like 'SKU_%' or sku like 'LOAD_%' or sku like 'UNLIM_%' or sku like 'BENCH_%')
      or product_id in (select product_id from items_left)
union all select 'order_items', count(*) from items_left
union all select 'inventory_movements', count(*) from movements_t
where not coalesce(notes like 'Test movement %' or notes like 'Load test %' or notes like 'Unlimited test %'
                   or notes like 'Benchmark movement %', false)""",
    "gen_load_customers": f"""with {NUMBERS}
select 'Load' as first_name, 'User_m1_' || i as last_name, 'load_m1_' || i || '@example.com' as email,
       '555-' || i || '000' as phone, date '2024-01-01' as registration_date,
       {_pick(["BRONZE", "SILVER", "GOLD"], "i % 3")} as customer_tier, i as total_orders,
       cast(i * 100 as decimal(14,2)) as total_spent
from numbers""",
    "gen_load_products": f"""with {NUMBERS}
select 'LOAD_m1_' || i as sku, 'Load Product m1_' || i as product_name,
       {_pick(["Electronics", "Clothing", "Home", "Sports", "Books"], "i % 5")} as category,
       {_cents("m1:price", 0, 327670)} as price, cast({_draw("m1:stock", 500)} + 100 as integer) as stock_quantity,
       true as is_active
from numbers""",
    "gen_load_orders": f"""with {NUMBERS},{_pool("customer", "c_custkey", "customer_id", 10)}
select i as order_no, customer_id,
       {_pick(["PENDING", "PROCESSING", "SHIPPED", "DELIVERED"], "i % 4")} as order_status,
       {_cents("m1:amount", 0, 327670, 12)} as total_amount, 'load_addr_m1_' || i as shipping_address
from numbers join customer_id_pool on place = least(i % 10, last)""",
    "gen_load_items": f"""with {NUMBERS},{_pool("part", "p_partkey", "product_id", 10)},
made as (
  select i as order_no, product_id, cast({_draw("m1:qty", 5)} + 1 as integer) as quantity,
         {_cents("m1:unit", 0, 32767)} as unit_price
  from numbers join product_id_pool on place = least(i % 10, last))
select *, cast(quantity * unit_price as decimal(12,2)) as total_price from made""",
    "gen_batch_orders": f"""
select i % 10 + 1 as customer_id, 'BATCH' as order_status, {_cents("batch_m1:amount", 0, 32767, 12)} as total_amount,
       'batch_m1_' || i as shipping_address
from (select row_number() over (order by o_orderkey) as i from orders)""",
    "gen_random": f"""with {NUMBERS},{_pool("customer", "c_custkey", "customer_id", 100)},{_pool("part", "p_partkey", "product_id", 100)},
made as (
  select i as order_no, customer_id,
         {_pick(["PENDING", "PROCESSING", "SHIPPED", "DELIVERED"], _draw("m2:status", 4))} as order_status,
         {_cents("m2:amount", 100, 100000, 12)} as total_amount,
         'bench_addr_m2_' || {_letters("m2:addr", 8)} as shipping_address, product_id,
         cast({_draw("m2:item_qty", 10)} + 1 as integer) as quantity, {_cents("m2:unit", 100, 10000)} as unit_price
  from numbers
  join customer_id_pool c on c.place = {_draw("m2:buyer", "(c.last + 1)")}
  join product_id_pool p on p.place = {_draw("m2:good", "(p.last + 1)")})
select *, cast(quantity * unit_price as decimal(12,2)) as total_price from made""",
    "stream_upserts": f"{_with(ORDER_STATE)} select * from orders_now",
    "compact_equals_replay": f"{_with(ORDER_STATE)} select * from orders_now",
    "per_table_jobs": f'{REPORT} select "table", target_count as row_count, true as same_content from report',
    "selected_tables": f"""{REPORT}
select "table", target_count as row_count, true as same_content from report where "table" in ('customers', 'products')""",
    "lag_over_time": f"""{REPORT} select * from report where "table" in ('orders', 'customers')""",
    "steady_latency": f"""with overall as ({_with(PROBES) + _stats("probes_t", (95, 99))}),
recent as ({_with(LAST_100) + _stats("last_100", (95,))}),
newest as ({_with(PROBES)} select "table", arg_max(latency_ms, probe_seq) as last_ms from probes_t group by 1)
select o.*, r.n as recent_n, r.avg_ms as recent_avg_ms, r.p95_ms as recent_p95_ms, coalesce(last_ms, 0) as last_ms
from overall o join recent r on r."table" = o."table" left join newest w on w."table" = o."table\"""",
    "allocate_keys": """
select load, count(*) as n_rows, count(*) as n_keys, cast(0 as bigint) as n_shared
from customer, (values (1), (2)) as l(load) group by load""",
    "batch_measures": f"""{_with(ORDER_FEED, CUSTOMER_FEED)}
select *, true as latencies_in_order from (
  select 'orders' as "table", count(*) as changes, count(*) filter (where op = 'd') as deletes, max(seq) as last_seq
  from order_feed
  union all select 'customers', count(*), count(*) filter (where op = 'd'), max(seq) from customer_feed
  union all select 'products', count(*) + count(*) filter (where p_size > 25) + count(*) filter (where p_type = 'PROMO'),
         count(*) filter (where p_type = 'PROMO'), case when bool_or(p_type = 'PROMO') then 2 when bool_or(p_size > 25) then 1 else 0 end
  from part
  union all select 'order_items', count(*) + count(*) filter (where l_returnflag = 'R'), count(*) filter (where l_returnflag = 'R'),
         case when bool_or(l_returnflag = 'R') then 2 else 1 end
  from lineitem
  union all select 'inventory_movements', count(*), cast(0 as bigint), 1 from events)""",
    "streamed_visibility": f"""{_with(ORDERS)}
select 'orders' as "table", shipping_address as marker, true as success from orders_t where shipping_address like 'latency_test_%'""",
    "quarantined_changes": f"""{_with(ORDER_FEED)}
select reasons, count(*) as messages from (
  select case when order_id % 97 in (4, 5) then 'table: null' when op = 'd' then '' when order_id % 97 in (1, 2) then 'after: unreadable; order_id: null'
              when order_id % 97 = 3 then 'order_id: null' else '' end as reasons
  from order_feed) group by 1""",
}

#: Counts that followed the stream refuse what the settled children refuse.
ORACLE["restrict_current"] = ORACLE["restrict_delete"]
#: A snapshot in chunks beside the log gives what a snapshot before the log gives.
ORACLE["chunked_snapshot"] = ORACLE["snapshot_plus_changes"]

"""DuckDB SQL that states independently what each registered query returns."""

from __future__ import annotations

import re

DIRTY_ORDERS = """
dirty_orders as (
  select cast(o_orderkey as varchar) as o_orderkey,
    case when o_orderkey % 101 = 0 then 'abc' when o_orderkey % 103 = 0 then null
         else cast(o_custkey as varchar) end as o_custkey,
    case when o_orderkey % 109 = 0 then '' when o_orderkey % 113 = 0 then 'NULL'
         when o_orderkey % 127 = 0 then 'None' else o_orderstatus end as o_orderstatus,
    case when o_orderkey % 107 = 0 then 'n/a'
         else cast(cast(o_totalprice as decimal(18,2)) as varchar) end as o_totalprice,
    case when o_orderkey % 131 = 0 then 'not-a-date' when o_orderkey % 137 = 0 then null
         else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as o_orderdate,
    o_orderpriority
  from orders)"""

VIOLATIONS = DIRTY_ORDERS + """,
violations as (
  select o_orderkey, 'not_null' as rule, 'o_custkey' as column_name, o_custkey as bad_value,
         'NULL Check Failed for Column o_custkey' as error_desc
  from dirty_orders where o_custkey is null
  union all
  select o_orderkey, 'not_null', 'o_orderstatus', o_orderstatus,
         'NULL Check Failed for Column o_orderstatus'
  from dirty_orders where o_orderstatus in ('', 'NULL', 'None')
  union all
  select o_orderkey, 'type', 'o_custkey', o_custkey, 'Data Type MisMatch for o_custkey'
  from dirty_orders where o_custkey is not null and try_cast(o_custkey as bigint) is null
  union all
  select o_orderkey, 'type', 'o_totalprice', o_totalprice, 'Data Type MisMatch for o_totalprice'
  from dirty_orders where try_cast(o_totalprice as double) is null
  union all
  select o_orderkey, 'date', 'o_orderdate', o_orderdate, 'Date Parse Failed for Column o_orderdate'
  from dirty_orders where o_orderdate is not null and try_cast(o_orderdate as timestamp) is null)"""

GOOD = VIOLATIONS + """,
good as (select * from dirty_orders where o_orderkey not in (select o_orderkey from violations))"""

TYPED = """
  select cast(o_orderkey as bigint) as o_orderkey, cast(o_custkey as bigint) as o_custkey,
         o_orderstatus, cast(o_totalprice as double) as o_totalprice,
         cast(o_orderdate as timestamp) as o_orderdate, o_orderpriority
  from good"""

NEWEST_EVENT = """
  select event_id, ts, user_id, event_type, value, props from (
    select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn
    from events where {where}) where rn = 1"""

# Change events: which rows are deletes, cut off, or lack their document.
FEED = """
feed as (
  select *, case when event_id % 50 = 0 then 'delete' when event_id % 3 = 0 then 'insert'
                 else 'update' end as op
  from events where event_id % 97 <> 0),
applied as (
  select *, (op = 'update' and event_id % 7 = 0) as bare from feed where op <> 'delete')"""


def _violations(rule: str) -> str:
    return f"with {VIOLATIONS} select * from violations where rule = '{rule}'"


def _later(line: str, header: str) -> str:
    return f"case when {line} > {header} then {line} else {header} end as Last_Modified_When"


_PURCHASE = f"""
select o_orderdate as OrderDate, o_orderkey as PurchaseOrderID, cast(l_quantity as int) as OrderedOuters,
       cast(l_quantity as int) * p_size as Ordered_Quantity, l_linenumber as ReceivedOuters,
       n_name as Package, l_linestatus = 'F' as IsOrderLineFinalized, o_custkey as SupplierID,
       l_partkey as StockItemID, {_later('l_shipdate', 'o_orderdate')}
from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey
join nation on n_nationkey = l_linenumber"""


def _order_lines(orders: str) -> str:
    price = "cast(cast(l_quantity as int) as decimal(10,0)) * cast(l_extendedprice as decimal(18,2))"
    excluding = f"round({price}, 2)"
    rate = "cast(cast(l_tax * 100 as decimal(6,3)) * 0.01 as decimal(7,5))"
    tax = f"round(({price}) * {rate}, 2)"
    return f"""
select o_orderdate as OrderDate, l_shipdate as PickingCompletedWhen, o_orderkey as OrderID,
       case when o_orderkey % 5 = 0 then o_orderkey + 1 end as BackorderOrderID,
       l_returnflag as Description, n_name as Package, cast(l_quantity as int) as Quantity,
       l_extendedprice as UnitPrice, l_tax * 100 as TaxRate,
       cast({excluding} as double) as Total_Excluding_Tax, cast({tax} as double) as Tax_Amount,
       cast({excluding} + {tax} as double) as Total_Including_Tax,
       c_nationkey as DeliveryCityID, c_custkey as CustomerID, l_partkey as StockItemID,
       o_custkey % 7 as SalespersonPersonID,
       case when o_orderstatus = 'F' then o_custkey % 5 end as PickedByPersonID,
       {_later('l_shipdate', 'o_orderdate')}
from {orders} join lineitem on o_orderkey = l_orderkey join nation on n_nationkey = l_suppkey % 25
join customer on c_custkey = o_custkey"""


def _count(name: str) -> str:
    return f"select '{name}' as table_name, date '2024-03-01' as part_date, count(*) as n_rows from {name}"


_GOLD: dict[str, str] = {
    "gold_city": """
select c_custkey as CityID, c_name as City, n_name as StateProvinceName, c_mktsegment as Location,
       r_name as CountryName, lower(r_name) as Continent, substr(r_name, 1, 2) as Region,
       substr(r_name, 2, 3) as Subregion, r_regionkey * 1000 as LatestRecordedPopulation
from customer, nation, region where c_nationkey = n_nationkey and n_regionkey = r_regionkey""",
    "gold_customer": """
select c.c_custkey as CustomerID, c.c_name as CustomerName, b.c_name as BillToCustomer,
       r_name as CustomerCategoryName, n_name as BuyingGroupName, c.c_name as FullName,
       c.c_mktsegment as DeliveryPostalCode
from customer c join nation on n_nationkey = c.c_nationkey and c.c_custkey % 7 <> 0
join region on r_regionkey = c.c_nationkey % 5
join customer b on b.c_custkey = c.c_custkey - c.c_custkey % 10""",
    "gold_employee": """
select c_custkey as WWI_Employee_ID, c_name as FullName, c_mktsegment as PreferredName,
       c_nationkey % 2 = 0 as IsSalesperson
from customer where c_acctbal < 0""",
    "gold_stock_item": """
select p_partkey as StockItemID, p_name as StockItemName, r_name as ColorName,
       u.n_name as Selling_Package, o.n_name as Buying_Package, p_brand as Brand, p_type as Size,
       p_size as LeadTimeDays, p_size as QuantityPerOuter, p_size > 25 as IsChillerStock,
       cast(p_partkey as varchar) as Barcode, p_retailprice as UnitPrice,
       p_retailprice as RecommendedRetailPrice, p_retailprice as TypicalWeightPerUnit
from part join nation u on u.n_nationkey = p_size % 25 join nation o on o.n_nationkey = (p_size + 1) % 25
left join region on p_partkey % 3 <> 0 and r_regionkey = p_partkey % 7""",
    "gold_supplier": """
select s_suppkey as SupplierID, s_name as SupplierName, r_name as SupplierCategoryName,
       c_name as FullName, cast(s_suppkey as varchar) as SupplierReference, s_nationkey as PaymentDays,
       cast(s_nationkey as varchar) as DeliveryPostalCode
from supplier join region on r_regionkey = s_nationkey % 5 join customer on c_custkey = s_suppkey""",
    "fact_stock_movement": """
select cast(ts as date) as Date_Key, event_id as StockItemTransactionID,
       case when event_id % 2 = 0 then event_id end as InvoiceID,
       case when event_id % 2 = 1 then event_id end as PurchaseOrderID,
       cast(trunc(value) as int) as Quantity, user_id as StockItemID, user_id as CustomerID,
       case when event_id % 2 = 1 then user_id end as SupplierID,
       cast(length(event_type) as int) as TransactionTypeID, ts as TransactionOccurredWhen
from events""",
    "fact_order_line": _order_lines("orders"),
    "fact_order": _PURCHASE,
    "fact_purchase": _PURCHASE,
    "fact_sales": f"""
select o_orderdate as InvoiceDate, case when o_orderstatus = 'F' then o_orderdate end as ConfirmedDeliveryTime,
       o_orderkey as InvoiceID, l_returnflag as Description, n_name as Package,
       cast(l_quantity as int) as Quantity, l_extendedprice as UnitPrice, l_tax * 100 as TaxRate,
       cast(cast(l_extendedprice as decimal(18,2)) - cast(l_tax as decimal(18,2)) as double)
         as Total_Excluding_Tax,
       l_tax as TaxAmount, l_discount as Profit, l_extendedprice as Total_Including_Tax,
       case when p_size <= 25 then cast(l_quantity as int) else 0 end as Total_Dry_Items,
       case when p_size > 25 then cast(l_quantity as int) else 0 end as Total_Chiller_Items,
       c_nationkey as DeliveryCityID, o_custkey as CustomerID,
       o_custkey - o_custkey % 10 as BillToCustomerID, l_partkey as StockItemID,
       o_custkey % 7 as SalespersonPersonID, {_later('l_shipdate', 'o_orderdate')}
from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey
join nation on n_nationkey = l_suppkey % 25 join customer on c_custkey = o_custkey
where o_orderkey % 11 <> 0
  and exists (select 1 from customer b where b.c_custkey = o_custkey - o_custkey % 10)""",
    "fact_transactions": """
select c.o_orderdate as TransactionDate, c.o_orderkey as CustomerTransactionID,
       cast(null as bigint) as SupplierTransactionID,
       case when c.o_orderstatus <> 'P' then c.o_orderkey * 2 end as InvoiceID,
       cast(null as bigint) as PurchaseOrderID, cast(null as varchar) as SupplierInvoiceNumber,
       c.o_totalprice as AmountExcludingTax, c.o_totalprice * 0 as TaxAmount,
       c.o_totalprice as TransactionAmount, c.o_totalprice * 0 as OutstandingBalance,
       c.o_orderstatus = 'F' as IsFinalized,
       coalesce(i.o_custkey, c.o_custkey - c.o_custkey % 10) as CustomerID,
       c.o_custkey - c.o_custkey % 10 as BillToCustomerID, cast(null as bigint) as SupplierID,
       cast(length(c.o_orderpriority) as int) as TransactionTypeID,
       case when c.o_orderstatus = 'P' then 4 end as PaymentMethodID, c.o_orderdate as LastEditedWhen
from orders c left join orders i on c.o_orderstatus <> 'P' and i.o_orderkey = c.o_orderkey * 2
union all
select l_shipdate, null, l_orderkey * 10 + l_linenumber, null, l_orderkey, l_returnflag, l_extendedprice,
       l_tax, l_extendedprice, l_discount, l_linestatus = 'F', null, null, l_suppkey, l_linenumber,
       case when l_returnflag = 'R' then 4 end, l_shipdate
from lineitem""",
}

_CHANGED = """
with new_orders as (
  select * replace (case when o_orderkey % 7 = 0 then 1 else o_custkey end as o_custkey) from orders),
new_lineitem as (
  select * replace (case when l_orderkey % 11 = 0 then l_quantity + 1 else l_quantity end as l_quantity) from lineitem),
new_customer as (
  select * replace (case when c_custkey % 50 = 0 then 99 else c_nationkey end as c_nationkey) from customer),
new_part as (select * replace (case when p_partkey % 40 = 0 then 1 else p_size end as p_size) from part),
new_nation as (select * replace (case when n_nationkey = 3 then 'RENAMED' else n_name end as n_name) from nation),
new_events as (select * replace (case when event_id % 9 = 0 then 1 else value end as value) from events)
"""


def _after_changes(sql: str) -> str:
    return _CHANGED + re.sub(r"\b(orders|lineitem|customer|part|nation|events)\b", r"new_\1", sql)


_GOLD_NAMES = {
    "Cities": "gold_city", "Customer": "gold_customer", "Employee": "gold_employee",
    "StockItem": "gold_stock_item", "Supplier": "gold_supplier", "StockMovement": "fact_stock_movement",
    "Movement": "fact_order_line", "Order": "fact_order", "Purchase": "fact_purchase",
    "Sales": "fact_sales", "Transactions": "fact_transactions",
}

_LANDED_VALUE = "case when event_id % 11 = 0 then 'abc' else cast(cast(value as decimal(18,2)) as varchar) end"
_LOST_CHECKPOINT = f"""
with landed as (
  select event_id, ts, user_id, event_type, {_LANDED_VALUE} as value from events
  union all
  select -event_id, ts, user_id, event_type, {_LANDED_VALUE} from events where event_id % 10 = 0
), newest as (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn
  from landed where value <> 'abc'
)
select 'good' as side, event_id, value from newest where rn = 1
union all select 'bronze', event_id, value from landed
union all select 'error', event_id, value from landed where value = 'abc'"""

_PACKED = """
with landed as (
  select event_id, cast(event_id % 2 as int) as batch_id, event_id % 11 = 0 as bad from events
  union all select -event_id, 2, event_id % 11 = 0 from events where event_id % 10 = 0)
select 'bronze' as side, event_id, batch_id from landed
union all select 'error', event_id, batch_id from landed where bad"""

_NEWEST_STREAM = """
with feed as (
  select event_id as seq, event_type as coll, user_id, (event_id + 1) % 3 as arrival,
         case when event_id % 13 <> 0 then cast(user_id as varchar) end as key,
         case when event_id % 2 = 0 then 'missing_document' when event_id % 13 = 0 then 'unordered' end as rule
  from events),
tops as (select coll, key, arrival, max(seq) as top from feed where rule is null group by all),
landed as (
  select *, top > coalesce(max(top) over (
    partition by coll, key order by arrival rows between unbounded preceding and 1 preceding), -1) as newer
  from tops)
select f.seq, f.coll, f.key, case when f.rule is null and not coalesce(f.seq = t.top and t.newer, false) then 'stale'
                             else f.rule end as rule
from feed f left join landed t on f.coll = t.coll and f.key = t.key and f.arrival = t.arrival"""

_PROFILE = f"with {DIRTY_ORDERS}" + " union all ".join(
    f"""
select '{c}' as column_name, count(*) as n_rows,
       count(*) filter ({c} is null or {c} = '' or {c} like '%NULL%' or {c} like '%None%') as n_missing,
       min({c}) as least, max({c}) as greatest from dirty_orders"""
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
)

_BALANCE = """
select cast(event_id % 2 as bigint) as batch_id, count(*) as n_rows, count(*) filter (event_id % 11 <> 0) as n_good,
       count(*) filter (event_id % 11 = 0) as n_bad, count(*) filter (event_id % 11 = 0) as n_violations,
       count(distinct (user_id, event_type)) filter (event_id % 11 <> 0) as n_logged
from events group by event_id % 2"""

_DRIFTED = "event_id % 3 = 2 and event_id % 7 = 0"
_DRIFT = f"""
select * replace (case when event_id % 3 <> 1 then props end as props)
from ({NEWEST_EVENT.format(where=f"event_id % 11 <> 0 and not ({_DRIFTED})")})"""
_RESCUED = f"""
select event_id, 'bronze' as side, '{{"channel":"c' || event_id % 4 || '"}}' as value from events where event_id % 3 = 1
union all select event_id, 'bronze', '{{"user_id":"u' || user_id || '"}}' from events where {_DRIFTED}
union all select event_id, 'schema_drift:user_id', 'u' || user_id from events where {_DRIFTED}
union all select event_id, 'type:value', 'abc' from events where event_id % 11 = 0"""

_KEYED = """
with keyed as (
  select case when l_partkey % 97 <> 0 then l_orderkey end as l_orderkey, l_linenumber, l_partkey, l_suppkey,
         count(*) over (partition by case when l_partkey % 97 <> 0 then l_orderkey end, l_linenumber) as n
  from lineitem)"""

_NEWEST_OF_ALL = NEWEST_EVENT.format(where="true")
_CURRENT_STREAM = NEWEST_EVENT.format(where="event_id % 11 <> 0")

ORACLE_SQL: dict[str, str] = {
    "null_profile": f"""with {DIRTY_ORDERS}
select count(*) filter (o_orderkey is null) as o_orderkey,
       count(*) filter (o_custkey is null) as o_custkey,
       count(*) filter (o_orderstatus is null or o_orderstatus = '' or o_orderstatus like '%NULL%'
                        or o_orderstatus like '%None%') as o_orderstatus,
       count(*) filter (o_totalprice is null) as o_totalprice
from dirty_orders""",
    "null_violations": _violations("not_null"),
    "type_violations": _violations("type"),
    "date_violations": _violations("date"),
    "quarantine_rows": f"""with {VIOLATIONS}
select d.*, v.error_desc from dirty_orders d join violations v on d.o_orderkey = v.o_orderkey""",
    "good_rows": f"with {GOOD} select * from good",
    "typed_rows": f"with {GOOD} {TYPED}",
    "quality_balance": f"""with {GOOD}
select (select count(*) from orders) as n_rows, (select count(*) from good) as n_good,
       (select count(distinct o_orderkey) from violations) as n_bad,
       (select count(*) from violations) as n_violations""",
    "error_report": f"""with {VIOLATIONS}
select 'orders' as table_name, rule, column_name, count(*) as n_rows,
       count(distinct o_orderkey) as n_keys, min(bad_value) as sample_value
from violations group by rule, column_name""",
    "null_fill": """
select o_orderkey, case when o_orderkey % 3 <> 0 then o_custkey else 0 end as o_custkey,
       case when o_orderkey % 4 <> 0 then o_totalprice else 0 end as o_totalprice,
       case when o_orderkey % 5 <> 0 then o_orderstatus else '' end as o_orderstatus
from orders""",
    "standardize_dates_text": f"""with {DIRTY_ORDERS}
select o_orderkey, strftime(try_cast(o_orderdate as timestamp), '%m-%d-%Y %H:%M:%S') as o_orderdate
from dirty_orders""",
    "standardize_dates_typed": f"""with {DIRTY_ORDERS}
select o_orderkey, try_cast(o_orderdate as timestamp) as o_orderdate from dirty_orders""",
    "header_report": """
select 'o_orderkey' as column_name, 'ok' as status, count(*) as n_documents from orders
union all select 'o_custkey', 'ok', count(*) from orders
union all select 'o_orderstatus', 'ok', count(*) from orders
union all select 'o_totalprice', 'ok', count(*) from orders where o_orderkey % 4 <> 0
union all select 'o_orderdate', 'ok', count(*) from orders
union all select 'o_orderpriority', 'missing', 0
union all select 'o_note', 'unexpected', count(*) from orders where o_orderkey % 5 = 0""",
    "flatten_nested": """
with kinds as (select 0 as pos, 'price' as kind union all select 1, 'discount')
select l_orderkey, l_linenumber, l_partkey, l_suppkey, pos as items_pos, l_shipdate as hdr_l_shipdate,
       l_returnflag as hdr_st_l_returnflag, l_linestatus as hdr_st_l_linestatus, kind as items_kind,
       case kind when 'price' then l_extendedprice when 'discount' then l_discount end as items_amount
from lineitem left join kinds on l_partkey % 9 > 1""",
    "flatten_embeddings": """
select vec_id, label, cast(i - 1 as int) as embedding_pos, embedding[i] as embedding
from (select *, unnest(range(1, len(embedding) + 1)) as i from embeddings)""",
    "flatten_siblings": """
select p_partkey, cast(w - 1 as int) as words_pos, words[w] as words, cast(s as int) as sizes_pos,
       cast(p_size + s as int) as sizes
from (select *, unnest(range(1, len(words) + 1)) as w
      from (select *, string_split(p_name, ' ') as words from part))
cross join (select 0 as s union all select 1)""",
    "sanitize_names": """
select p_partkey as p_key, p_name as p_name, p_size as p_size_cm, p_type as p_type__ from part""",
    "json_parse": """
select event_id, cast(json_extract_string(props, '$.k') as int) as k from events""",
    "typed_documents": """
select event_id, ts, user_id, event_type, value, props, event_id as source_id
from events where event_id % 97 <> 0""",
    "json_corrupt_quarantine": """
select event_id as source_id, 'corrupt' as rule, '{"event_id": ' as bad_value
from events where event_id % 97 = 0""",
    "cdc_post_images": NEWEST_EVENT.format(
        where="event_id % 97 <> 0 and event_id % 50 <> 0 and (event_id % 3 = 0 or event_id % 7 <> 0)"
    ),
    "cdc_lookup_images": f"""with {FEED}
select op, event_type as coll, cast(event_id as varchar) as key, event_id, ts, user_id, value
from applied where not bare or event_id % 11 <> 0""",
    "cdc_rejected": f"""with {FEED}
select event_id as seq, null as op, null as key, 'corrupt' as rule from events where event_id % 97 = 0
union all select event_id, op, cast(event_id as varchar), 'unsupported_op' from feed where op = 'delete'
union all select event_id, op, cast(event_id as varchar), 'missing_document' from applied
where bare and event_id % 11 = 0""",
    "cdc_routed": f"""with {FEED}
select event_id as seq, op, 'shop' as db, cast(event_id as varchar) as key
from applied where not bare and event_type = 'click'""",
    "cdc_feed_stream": f"""with {FEED}
select event_type as coll, op, cast(event_id as varchar) as key, event_id as seq, cast(null as varchar) as rule
from applied where not bare or event_id % 11 <> 0
union all select null, null, null, event_id, 'corrupt' from events where event_id % 97 = 0
union all select event_type, op, cast(event_id as varchar), event_id, 'unsupported_op' from feed where op = 'delete'
union all select event_type, op, cast(event_id as varchar), event_id, 'missing_document' from applied
where bare and event_id % 11 = 0""",
    "cdc_lookup_shared_keys": """
with newest as (
    select event_type, user_id, max(event_id) as event_id from events where user_id % 11 <> 0 group by all
)
select e.event_id as seq, e.event_type as coll, case when e.event_id % 13 <> 0 then cast(e.user_id as varchar) end as key,
       case when e.event_id % 2 = 1 then e.event_id else n.event_id end as document_id,
       case when e.event_id % 2 = 0 and n.event_id is null then 'missing_document' end as rule
from events e left join newest n
on e.event_type = n.event_type and e.user_id = n.user_id and e.event_id % 13 <> 0""",
    "latest_version": NEWEST_EVENT.format(where="true"),
    "upsert_batch": _NEWEST_OF_ALL,
    "upsert_by_union": _NEWEST_OF_ALL,
    "upsert_by_full_join": _NEWEST_OF_ALL,
    "upsert_bucketed": _NEWEST_OF_ALL,
    "upsert_stream": _CURRENT_STREAM,
    "stream_errors": """
select event_id, 'type' as rule, 'value' as column_name, 'abc' as bad_value, date '2024-03-01' as part_date
from events where event_id % 11 = 0""",
    "stream_bronze": """
select event_id, case when event_id % 11 = 0 then 'abc' else cast(cast(value as decimal(18,2)) as varchar) end
       as value, date '2024-03-01' as part_date, cast(event_id % 2 as int) as batch_id
from events""",
    "stream_rerun_idempotent": _CURRENT_STREAM,
    "stream_lost_checkpoint": _LOST_CHECKPOINT,
    "stream_balance": _BALANCE,
    "stream_packed": _PACKED,
    "cdc_newest_stream": _NEWEST_STREAM,
    "profile_merged": _PROFILE,
    "together_order_line": _GOLD["fact_order_line"],
    "together_purchase": _GOLD["fact_purchase"],
    "together_sales": _GOLD["fact_sales"],
    "stream_schema_drift": _DRIFT,
    "stream_rescued": _RESCUED,
    "key_violations": f"""{_KEYED}
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       case when l_orderkey is null then 'null_key' else 'duplicate_key' end as rule,
       'l_orderkey,l_linenumber' as column_name,
       '{{"l_orderkey":' || coalesce(cast(l_orderkey as varchar), 'null') || ',"l_linenumber":' || l_linenumber || '}}'
         as bad_value,
       case when l_orderkey is null then 'Primary Key Is NULL: ' else 'Primary Key Is Not Unique: ' end
         || 'l_orderkey,l_linenumber' as error_desc
from keyed where l_orderkey is null or n > 1""",
    "unique_keys": f"{_KEYED} select * exclude (n) from keyed where l_orderkey is not null and n = 1",
    "seed_repeated_keys": _NEWEST_OF_ALL,
    "bronze_roundtrip": "select *, date '2024-03-01' as part_date from customer",
    "full_reload_overwrite": "select *, date '2024-03-02' as part_date from orders where o_orderstatus <> 'F'",
    "landing_append": """
select *, case when event_id % 2 = 0 then date '2024-03-01' else date '2024-03-02' end as part_date
from events""",
    "schema_drift": """
select * exclude (o_orderpriority), case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority,
       case when o_orderstatus = 'F' then date '2024-03-01' else date '2024-03-02' end as part_date
from orders""",
    "ingest_all_counts": " union all ".join(
        _count(n)
        for n in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
    ),
    "silver_load": f"with {GOOD} select *, date '2024-03-01' as part_date from ({TYPED})",
    "error_day_scan": f"""with {VIOLATIONS}
select o_orderkey, error_desc, date '2024-03-02' as part_date from violations where rule = 'not_null'""",
    "except_distinct": """
select o_custkey, nullif(o_orderstatus, 'P') as status from orders
except
select o_custkey, nullif(o_orderstatus, 'P') from orders where o_totalprice > 400000""",
    "union_all": """
select c_custkey as party_key, c_name as name, c_mktsegment as segment from customer
union all select s_suppkey, s_name, null from supplier""",
    **_GOLD,
    "gold_ordered": _GOLD["fact_sales"],
    "gold_catalog_counts": " union all ".join(
        f"select '{name}_gold' as table_name, count(*) as n_rows from ({_GOLD[key]})"
        for name, key in _GOLD_NAMES.items()
    ),
    "incremental_to_gold": f"""with {GOOD}, typed as (
  select * replace (case when o_orderkey % 3 = 0 then 1 when o_orderkey % 10 = 0 then 2 else o_custkey end as o_custkey)
  from ({TYPED})) {_order_lines('typed')}""",
    **{
        f"refresh_{name}": _after_changes(_GOLD[f"fact_{name}"])
        for name in ("order_line", "purchase", "sales", "transactions", "stock_movement")
    },
    "clean_order_lines": f"""with {GOOD}, typed as ({TYPED}) {_order_lines('typed')}""",
}

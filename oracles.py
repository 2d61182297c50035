"""DuckDB SQL that each query must equal, written from the tables upwards."""

from __future__ import annotations

# A mean of cents rounded half up without leaving whole numbers.
MEAN = "cast((2 * sum({x}) + count({x})) // (2 * count({x})) as double) / 100"


def mean(x: str) -> str:
    return MEAN.format(x=x)


CENTS = "cast(round(l_extendedprice * 100) as bigint)"
REVENUE = "cast(sum(cast(l_extendedprice as decimal(18, 2))) as double)"

CUSTOMERS = """
customers as (
    select c_custkey, c_name, n_name, c_mktsegment
    from customer left join nation on n_nationkey = c_nationkey
)"""

LINES_WITH_CUSTOMER = f"""
{CUSTOMERS}, sold as (
    select l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority, c_name, n_name, c_mktsegment
    from lineitem l
    left join orders o on o_orderkey = l_orderkey
    left join customers on c_custkey = o_custkey
)"""

# The sale events every message, alert and summary is made from.
SALE_EVENTS = f"""
{CUSTOMERS}, numbered as (
    select event_id as n, ts, user_id, value, event_type,
           cast(props::json->>'k' as int) as k, event_id % (select max(p_partkey) * 5 // 4 + 1 from part) as partkey
    from events
), priced as (
    select n, ts, k,
           printf('EVT-%06d', n) as event_id,
           printf('TRX-%08d', n) as transaction_id,
           printf('CLI-%06d', user_id) as customer_id,
           printf('PROD-%06d', partkey) as product_id,
           coalesce(c_name, 'desconocido') as customer_name,
           coalesce(p_name, 'desconocido') as product_name,
           coalesce(p_type, 'desconocido') as category,
           coalesce(n_name, 'desconocido') as city,
           printf('Store %d', user_id % 5) as store,
           cast(k % 5 + 1 as int) as quantity,
           value as unit_price,
           round(value * (k % 5 + 1), 2) as total_amount,
           cast(coalesce(p_size * 10, 0) as int) as stock_actual,
           cast(coalesce(10 + p_partkey % 31, 0) as int) as stock_minimo
    from numbered
    left join customers on c_custkey = user_id
    left join part on p_partkey = partkey
), scored as (
    select *,
           case when stock_actual <= stock_minimo then 70 + k % 26
                when total_amount >= 1500 then 40 + k % 36
                else 5 + k % 41 end as points
    from priced
), sale_events as (
    select *, points / 100.0::double as risk_score, points >= 70 as is_risk,
           date_trunc('second', ts) as event_timestamp
    from scored
)"""

MESSAGE_FIELDS = """event_id, transaction_id, customer_id, product_id, customer_name,
    product_name, category, city, store, quantity, unit_price, total_amount, stock_actual,
    stock_minimo, risk_score, is_risk"""

SUMMARY = f"""count(*) as n_events,
    cast(sum(cast(total_amount as decimal(18, 2))) as double) as revenue,
    {mean('points')} as mean_risk"""

# Delivery messages: signup and purchase place, view delivers, click delays, error cancels.
ORDER_EVENTS = f"""
{CUSTOMERS}, order_events as (
    select printf('TRX-%08d', event_id) as order_id, n_name as district,
           cast(user_id as varchar) as courier_id, event_type, value,
           cast(props::json->>'k' as int) as k, date_trunc('second', ts) as event_timestamp
    from events left join customers on c_custkey = user_id
)"""

DELIVERY_DAYS = f"""
{CUSTOMERS}, last_shipment as (
    select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey
), delivery as (
    select o_orderkey as order_id, o_custkey as customer_id,
           cast(date_diff('day', o_orderdate, shipped) as int) as days
    from last_shipment join orders on o_orderkey = l_orderkey
)"""

LOW_STOCK = """
stocked as (
    select p_partkey as product_id, p_name as product_name, p_type as category,
           p_size * 10 as stock, cast(10 + p_partkey % 31 as int) as stock_minimum,
           p_brand as supplier
    from part
), low_stock as (select * from stocked where stock <= stock_minimum)"""

RATING_CROSSINGS = f"""
{ORDER_EVENTS}, rated as (
    select courier_id, order_id, event_timestamp, k,
           cast(substr(order_id, 5) as bigint) % 3 as batch_id
    from order_events where event_type = 'view'
), running as (
    select *, count(*) over so_far as n_ratings, sum(5 * k) over so_far as hundredths
    from rated
    window so_far as (partition by courier_id order by batch_id, event_timestamp, order_id
                      rows between unbounded preceding and current row)
), judged as (
    select *, hundredths < 250 * n_ratings as low,
           coalesce(lag(hundredths < 250 * n_ratings) over (
               partition by courier_id order by n_ratings), false) as was_low
    from running
), crossings as (
    select courier_id, case when low then 'begin' else 'end' end as alert, n_ratings,
           cast((2 * hundredths + n_ratings) // (2 * n_ratings) as double) / 100 as mean_rating,
           order_id, event_timestamp, batch_id
    from judged where low <> was_low
)"""

# Sale lines in the order that an md5 of seed and columns gives.
DRAWN = """
with sold as (
    select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id,
           l_suppkey as store_id, cast(l_quantity as int) as quantity,
           cast(round(l_discount * 100) as int) as discount_pct
    from lineitem
), ordered as (
    select *, row_number() over (order by md5('{seed}:' || order_id || ':' || line_number || ':'
        || product_id || ':' || store_id || ':' || quantity || ':' || discount_pct)) - 1 as place
    from sold
)"""

GIVEN = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def profiled(name: str, columns_of: str, rows: str) -> str:
    return f"""select '{name}' as table_name, (select count(*) from ({rows})) as n_rows,
        count(*) as n_columns, string_agg(column_name, ',' order by i) as column_names
        from ({columns_of})"""


def given_profile(name: str) -> str:
    return profiled(name, f"""select column_name, ordinal_position as i
        from information_schema.columns where table_name = '{name}'""", f"select 1 from {name}")


def export_profile(name: str, names: str, rows: str) -> str:
    return profiled(name, f"""select unnest(string_split('{names}', ',')) as column_name,
        generate_subscripts(string_split('{names}', ','), 1) as i""", rows)


ENRICHED = f"""
with {LINES_WITH_CUSTOMER}
select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id,
       l_suppkey as store_id, cast(l_quantity as int) as quantity, l_extendedprice as amount,
       o_custkey as customer_id, o_orderdate as sold_at, c_name as customer_name,
       n_name as city, c_mktsegment as segment, p_name as product_name, p_type as category,
       p_retailprice as price, p_size * 10 as stock,
       cast(10 + p_partkey % 31 as int) as stock_minimum, p_brand as supplier,
       s_name as store{{more}}
from sold
left join part on p_partkey = l_partkey
left join supplier on s_suppkey = l_suppkey
"""

ORACLES = {
    "sales_enriched": ENRICHED.format(more=""),
    "kpi_category": f"""
        select p_type as category, count(*) as n_sales, {REVENUE} as revenue,
               {mean(CENTS)} as mean_ticket
        from lineitem left join part on p_partkey = l_partkey group by p_type""",
    "kpi_city": f"""
        with {LINES_WITH_CUSTOMER}
        select n_name as city, count(*) as n_sales, {REVENUE} as revenue,
               {mean(CENTS)} as mean_ticket
        from sold group by n_name""",
    "kpi_segment": f"""
        with {LINES_WITH_CUSTOMER}
        select c_mktsegment as segment, count(distinct o_custkey) as n_customers,
               {REVENUE} as spend, {mean(CENTS)} as mean_spend
        from sold group by c_mktsegment""",
    "kpi_store": f"""
        select s_name as store, count(*) as n_sales, {REVENUE} as revenue
        from lineitem left join supplier on s_suppkey = l_suppkey group by s_name""",
    "store_counts": """
        select s_name as store, count(*) as n_sales
        from lineitem left join supplier on s_suppkey = l_suppkey group by s_name""",
    "low_stock": f"with {LOW_STOCK} select * from low_stock",
    "campaigns_by_segment": f"""
        with {LINES_WITH_CUSTOMER}
        select c_mktsegment as segment, o_orderpriority as channel, count(*) as n_campaigns,
               {mean('100 * cast(round(l_discount * 100) as bigint)')} as mean_discount
        from sold group by all""",
    "sale_amount": """
        select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id,
               cast(l_quantity as int) as quantity, p_retailprice as price,
               round(p_retailprice * l_quantity, 2) as amount
        from lineitem left join part on p_partkey = l_partkey""",
    "dataset_profile": " union all ".join(map(given_profile, GIVEN)),
    "sample_sales": """
        select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id,
               l_suppkey as store_id, cast(l_quantity as int) as quantity,
               l_extendedprice as amount, cast(draw as int) as draw
        from lineitem, range(1, 5) as draws(draw)
        where substr(md5('sales-7:' || draw || ':' || l_orderkey || ':' || l_linenumber), 1, 8)
              < printf('%08x', cast(round(0.01 / 4 * 4294967296) as bigint))""",
    "customers_per_segment_sketch": f"""
        with {CUSTOMERS}
        select c_mktsegment as segment, strftime(o_orderdate, '%Y') as year,
               count(*) as n_orders, count(distinct o_custkey) as n_customers
        from orders left join customers on c_custkey = o_custkey group by all""",
    "returning_customers_sketch": f"""
        with {CUSTOMERS}, spans as (
            select c_mktsegment as segment, o_custkey,
                   bool_or(o_orderdate < '1996-01-01') as early,
                   bool_or(o_orderdate >= '1996-01-01' and o_orderdate < '1998-01-01') as middle,
                   bool_or(o_orderdate >= '1998-01-01') as late
            from orders left join customers on c_custkey = o_custkey group by all)
        select segment, count(*) filter (early and middle) as n_both,
               count(*) filter (early and middle and late) as n_all
        from spans group by segment""",
    "csv_files": f"""
        with {CUSTOMERS}
        select printf('CLI-%06d', c_custkey) as customer_id, c_name as customer_name,
               'A, "B"' as last_name, cast(c_custkey % 80 + 18 as int) as age, n_name as city,
               c_mktsegment as segment, cast(null as varchar) as email
        from customers""",
    "json_lines": """
        select cast(p_partkey as varchar) as product_id, p_name as product_name,
               p_type as category, p_retailprice as price, p_size * 10 as stock,
               cast(10 + p_partkey % 31 as int) as stock_minimum, p_brand as supplier
        from part""",
    "report_reread": f"""
        select s_name as store, count(*) as n_sales, {REVENUE} as revenue
        from lineitem left join supplier on s_suppkey = l_suppkey group by s_name""",
    "tables_export": " union all ".join((
        export_profile("sales", "order_id,line_number,product_id,store_id,quantity,amount,"
                       "discount_pct,shipped_at,cancelled", "select 1 from lineitem"),
        export_profile("low_stock", "product_id,product_name,category,stock,stock_minimum,supplier",
                       "select 1 from part where p_size * 10 <= 10 + p_partkey % 31"),
        export_profile("kpi_store", "store,n_sales,revenue",
                       "select distinct s_name from lineitem left join supplier on s_suppkey = l_suppkey"),
    )),
    "preview": f"""
        select order_id, customer_name, product_name, category, quantity, amount, stock
        from ({ENRICHED.format(more=", l_shipdate")})
        order by order_id, product_id, store_id, line_number, l_shipdate, amount limit 10""",
    "top_products_by_units": """
        select l_partkey as product_id, any_value(p_name) as product_name,
               cast(sum(l_quantity) as bigint) as units
        from lineitem left join part on p_partkey = l_partkey
        group by l_partkey order by units desc, product_id limit 10""",
    "top_cities": f"""
        with {LINES_WITH_CUSTOMER}
        select n_name as city, count(*) as n_sales, {REVENUE} as revenue,
               {mean(CENTS)} as mean_ticket
        from sold group by n_name order by revenue desc, city limit 10""",
    "top_low_stock": f"""
        with {LOW_STOCK}
        select product_id, product_name, stock from low_stock
        order by stock, product_id limit 10""",
    "revenue_share_by_segment": f"""
        with {LINES_WITH_CUSTOMER}, spent as (
            select c_mktsegment as segment, sum({CENTS}) as cents from sold group by all)
        select segment,
               cast((2 * 1000 * cents + sum(cents) over ()) // (2 * sum(cents) over ()) as double)
                   / 10 as share_pct
        from spent""",
    "revenue_labels": f"""
        select p_type as category, {REVENUE} as revenue,
               format('{{:,}}', cast(round({REVENUE}) as bigint)) as label
        from lineitem left join part on p_partkey = l_partkey group by p_type""",
    "campaign_calendar": """
        select printf('CMP-%05d', o_orderkey) as campaign_id,
               date_trunc('day', o_orderdate) as start_date,
               cast(5 + o_orderkey % 26 as int) as duration_days,
               date_trunc('day', o_orderdate) + to_days(cast(5 + o_orderkey % 26 as int)) as end_date
        from orders""",
    "event_type_counts": "select event_type, count(*) as n_events from events group by event_type",
    "log_parse": """
        select case event_type when 'error' then 'ERROR' when 'signup' then 'WARNING'
               else 'INFO' end as level,
               printf('Store %d', user_id % 5) as store, upper(event_type) as event,
               count(*) as n_lines, min(date_trunc('second', ts)) as first_logged_at,
               max(date_trunc('second', ts)) as last_logged_at
        from events group by all""",
    "orders_by_district": f"""
        with {CUSTOMERS}
        select n_name as city, count(*) as n_orders
        from orders left join customers on c_custkey = o_custkey group by n_name""",
    "avg_delivery_time": f"""
        with {DELIVERY_DAYS}
        select n_name as city, count(*) filter (days >= 0) as n_orders,
               count(*) filter (not coalesce(days >= 0, false)) as n_invalid,
               {mean('case when days >= 0 then 100 * days end')} as mean_days
        from delivery left join customers on c_custkey = customer_id group by n_name""",
    "delayed_orders": f"with {DELIVERY_DAYS} select * from delivery where days > 30",
    "cancellations_by_district": f"""
        with {LINES_WITH_CUSTOMER}
        select n_name as city, count(distinct l_orderkey) as n_orders, count(*) as n_items
        from sold where l_returnflag = 'R' group by n_name""",
    "courier_ranking": """
        with done as (
            select l_suppkey, count(*) as n from lineitem where l_returnflag <> 'R'
            group by l_suppkey)
        select l_suppkey as courier_id, s_name as courier_name, n as n_deliveries,
               rank() over (order by n desc) as rank
        from done left join supplier on s_suppkey = l_suppkey""",
    "events_to_json": f"""
        with {SALE_EVENTS}, dated as (
            select {MESSAGE_FIELDS},
                   strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') as event_timestamp
            from sale_events)
        select transaction_id as key, cast(to_json(dated) as varchar) as value from dated""",
    "risk_score": f"""
        with {SALE_EVENTS}
        select event_id, total_amount, stock_actual, stock_minimo, risk_score, is_risk
        from sale_events""",
    "stream_parse_events": f"""
        with {SALE_EVENTS}
        select transaction_id as message_key, ts as kafka_timestamp, {MESSAGE_FIELDS},
               event_timestamp
        from sale_events""",
    "stream_enrich_events": f"""
        with {SALE_EVENTS}
        select event_id, customer_id, product_id, customer_name, city, product_name, category,
               store, stock_actual, stock_minimo
        from sale_events""",
    "stream_events_sink": f"""
        with {SALE_EVENTS}
        select transaction_id as message_key, ts as kafka_timestamp, {MESSAGE_FIELDS},
               event_timestamp, cast(0 as bigint) as batch_id
        from sale_events""",
    "stream_alerts": f"""
        with {SALE_EVENTS}
        select transaction_id, customer_name, product_name, category, city, total_amount,
               stock_actual, stock_minimo, risk_score, event_timestamp,
               cast(0 as bigint) as batch_id
        from sale_events
        where is_risk or risk_score >= 0.70 or stock_actual <= stock_minimo""",
    "stream_summary_category": f"""
        with {SALE_EVENTS}
        select category, {SUMMARY}, cast(0 as bigint) as batch_id from sale_events
        group by category""",
    "stream_summary_batches": f"""
        with {SALE_EVENTS}
        select category, {SUMMARY}, n % 3 as batch_id from sale_events group by all""",
    "stream_summary_city": f"""
        with {SALE_EVENTS}
        select city, {SUMMARY}, cast(0 as bigint) as batch_id from sale_events group by city""",
    "stream_windowed_summary": f"""
        with {SALE_EVENTS}, placed as (
            select *, time_bucket(interval '10 seconds', event_timestamp) as window_start
            from sale_events)
        select window_start, window_start + interval '10 seconds' as window_end, category,
               {SUMMARY}
        from placed group by window_start, category""",
    "stream_windows_late": f"""
        with {SALE_EVENTS}, placed as (
            select *, date_trunc('day', event_timestamp) as window_start,
                   date_diff('day', (select date_trunc('day', min(ts)) from events), ts) // 5
                       + case when n % 10 = 0 then 2 else 0 end as part
            from sale_events
        ), parts as (
            select part, max(max(event_timestamp)) over (
                       order by part rows between unbounded preceding and 1 preceding) as newest
            from placed group by part
        ), judged as (
            select placed.*, coalesce(
                window_start + interval 1 day <= newest - interval 1 day, false) as late
            from placed join parts using (part)
        ), summed as (
            select window_start, category, count(*) filter (not late) as n_on_time,
                   cast(sum(cast(total_amount as decimal(18, 2))) filter (not late) as double)
                       as revenue,
                   {mean('case when not late then points end')} as mean_risk,
                   count(*) filter (late) as n_late
            from judged group by window_start, category
        )
        select window_start, window_start + interval 1 day as window_end, category,
               n_on_time as n_events, revenue,
               case when n_on_time > 0 then mean_risk end as mean_risk, n_late
        from summed
        where window_start + interval 1 day
              <= (select max(event_timestamp) - interval 1 day from sale_events)""",
    "stream_running_totals": f"""
        with {ORDER_EVENTS}
        select district, count(*) as n_orders,
               cast(sum(cast(value as decimal(18, 2))) as double) as amount
        from order_events where event_type in ('purchase', 'signup') group by district""",
    "stream_cancellations_by_reason": f"""
        with {ORDER_EVENTS}
        select printf('reason %d', k % 5) as cancel_reason, count(*) as n_cancelled
        from order_events where event_type = 'error' group by all""",
    "stream_delay_alerts": f"""
        with {ORDER_EVENTS}
        select order_id, district, courier_id, value as delay_minutes,
               printf('reason %d', k % 5) as delay_reason, event_timestamp
        from order_events where event_type = 'click' and value > 30""",
    "stream_low_rating": f"""
        with {ORDER_EVENTS}
        select courier_id, count(*) as n_ratings, {mean('5 * k')} as mean_rating
        from order_events where event_type = 'view'
        group by courier_id having sum(5 * k) < 250 * count(*)""",
}
# Tables replaced and compacted, results served from snapshots, alerts that begin and end.
ORACLES |= {
    "csv_quarantine": """
        select case when c_custkey % 10 not in (1, 2, 3) then c_custkey else -1 end as customer_id,
               case when c_custkey % 10 not in (1, 2, 3) then c_name || ', "x"' end as name,
               case when c_custkey % 10 not in (1, 2, 3)
                    then cast(c_custkey % 80 + 18 as int) else -1 end as age,
               case when c_custkey % 10 not in (1, 2, 3) then c_mktsegment end as segment,
               case c_custkey % 10 when 1 then c_custkey || ',' || c_name
                    when 2 then c_custkey || ',Eva,old,' || c_mktsegment
                    when 3 then c_custkey || ',"Eva,30,' || c_mktsegment end as rejected
        from customer""",
    "draw_sales": DRAWN.format(seed="sales-8") + """
        select order_id, line_number, product_id, store_id, quantity, discount_pct
        from ordered where place < 1000""",
    "draw_sales_again": DRAWN.format(seed="sales-9") + """
        , drawn as (
            select cast(cast('0x' || substr(md5('sales-9:draw:' || i), 1, 15) as bigint)::hugeint
                        * (select count(*) from ordered) // 1152921504606846976 as bigint) as place,
                   count(*) as times
            from range(100000) as draws(i) group by all)
        select order_id, line_number, product_id, store_id, quantity, discount_pct, times
        from ordered join drawn using (place)""",
    "sales_months_replaced": ORACLES["sales_enriched"],
    "sales_enriched_bucketed": ORACLES["sales_enriched"],
    "collections_export": """
        select p_partkey as product_id, p_name as product_name, p_type as category,
               p_retailprice as price, p_size * 10 as stock,
               cast(10 + p_partkey % 31 as int) as stock_minimum, p_brand as supplier
        from part""",
    "json_array_documents": """
        select p_partkey as product_id, p_name as product_name, p_type as category,
               p_retailprice as price, p_size * 10 as stock,
               cast(10 + p_partkey % 31 as int) as stock_minimum, p_brand as supplier
        from part""",
    "stream_summary_maintained": f"""
        with {SALE_EVENTS}
        select category, {SUMMARY} from sale_events group by category""",
    "stream_events_compacted": f"""
        with {SALE_EVENTS}
        select transaction_id as message_key, ts as kafka_timestamp, {MESSAGE_FIELDS},
               event_timestamp, n % 3 as batch_id
        from sale_events""",
    "stream_rating_crossings": f"with {RATING_CROSSINGS} select * from crossings",
    "stream_rating_alerts_on": f"""
        with {RATING_CROSSINGS}
        select * exclude (alert) from crossings where alert = 'begin'
        qualify n_ratings = max(n_ratings) over (partition by courier_id)
            and n_ratings = (select max(c.n_ratings) from crossings c
                             where c.courier_id = crossings.courier_id)""",
    "stream_running_totals_served": ORACLES["stream_running_totals"],
    "stream_cancellations_served": ORACLES["stream_cancellations_by_reason"],
    "stream_low_rating_served": ORACLES["stream_low_rating"],
}

"""One SQL statement per registered query."""

from __future__ import annotations

from oracle.prelude import AS_OF, day, money, pct, ratio, statement
from starloom.plans.validation import CHECKS
from starloom.sources.contracts import SOURCE_TABLES

SQL: dict[str, str] = {}

# Warehouse tables

SQL["dim_date"] = f"""
    select date_key, {day('full_date')} as full_date, year, quarter, month, day, month_name,
           day_name, day_of_week, day_of_year, week_of_year, is_weekend, is_leap_year,
           fiscal_year, fiscal_quarter from wh_date"""

SQL["dim_store"] = f"""
    select store_key, store_id, name, city, phone, manager, {day('opened_date')} as opened_date
    from wh_store"""

SQL["dim_employee"] = f"""
    select employee_key, employee_id, full_name, email, {day('hire_date')} as hire_date,
           manager_name, store_name from wh_employee"""

SQL["dim_product"] = f"""
    select product_key, product_id, name, brand, category_name, parent_category_name,
           category_path, {money('unit_price')} as unit_price, {money('cost')} as cost
    from wh_product"""

SQL["category_tree"] = """
    select c.category_id, c.name, p.name as parent_name,
           concat_ws(' > ', p.name, c.name) as path,
           if(p.name is null, 1, 2)::bigint as depth
    from src_categories c left join src_categories p on p.category_id = c.parent_category_id"""

SQL["geo_tree"] = """
    select 'r' || r_regionkey as node, r_name as name, null as parent_name, r_name as path,
           1::bigint as depth from region
    union all
    select 'n' || n_nationkey, n_name, r_name, r_name || ' > ' || n_name, 2
    from nation join region on r_regionkey = n_regionkey
    union all
    select 'c' || c_custkey, c_name, n_name, r_name || ' > ' || n_name || ' > ' || c_name, 3
    from customer join nation on n_nationkey = c_nationkey
    join region on r_regionkey = n_regionkey"""

SQL["upsert_type1"] = f"""
    with old as (select product_id, row_number() over (order by product_id) as k
                 from src_products where brand <> 'Brand#2'),
    fresh as (select product_id, row_number() over (order by product_id)
                     + (select count(*) from old) as k
              from src_products where brand = 'Brand#2')
    select coalesce(old.k, fresh.k) as product_key, product_id, p.name, brand,
           {money("if(brand = 'Brand#1', (unit_price * 101 + 50) // 100, unit_price)")} as unit_price,
           case when old.k is null then 'inserted'
                when brand = 'Brand#1' and (unit_price * 101 + 50) // 100 <> unit_price
                then 'updated' else 'kept' end as change
    from src_products p left join old using (product_id) left join fresh using (product_id)"""

_CUSTOMER = f"""
    select customer_key, customer_id, full_name, email, phone, address, city, state, age, sex,
           {day('signup_date')} as signup_date, {day('valid_from')} as valid_from,
           {day('valid_to')} as valid_to, is_current from wh_customer"""
SQL["scd2_history"] = _CUSTOMER
SQL["scd2_current"] = _CUSTOMER + " where valid_to is null"

SQL["scd2_probe"] = _CUSTOMER + " where customer_id in (10, 25, 50, 77)"

SQL["scd2_idempotent"] = """
    select 1::bigint as load, 0::bigint as closed, (select count(*) from customer) as inserted
    union all select 2, (select count(*) from moved_ids), (select count(*) from moved_ids)
    union all select 3, 0, 0"""

SQL["surrogate_keys"] = "select order_item_id, order_id, product_id from src_order_items"

_FACT_MONEY = ", ".join(
    f"{money(c)} as {c}"
    for c in ("gross_amount", "discount_amount", "net_amount", "cost_amount", "profit_amount")
)
SQL["fact_sales"] = f"""
    select sales_key, date_key, customer_key, product_key, store_key, employee_key, order_id,
           order_status, channel, quantity, {_FACT_MONEY} from wh_fact"""

SQL["star_from_csv"] = f"""
    with single as (select customer_id, row_number() over (order by customer_id) as one_key from src_customers)
    select f.sales_key, f.date_key, single.one_key as customer_key, f.product_key, f.store_key, f.employee_key,
           f.order_id, f.order_status, f.channel, f.quantity, {_FACT_MONEY}
    from wh_fact f join wh_customer c using (customer_key) join single on single.customer_id = c.customer_id"""

_LOADED = [
    ("dim_store", "wh_store"), ("dim_employee", "src_employees"), ("dim_product", "wh_product"),
    ("dim_customer", "src_customers"), ("fact_sales", "wh_fact"),
]
_MOVED, _REKEYED = (
    "(select count(*) from moved_ids)",
    "(select count(*) from wh_fact where customer_key > (select count(*) from src_customers))",
)
SQL["warehouse_reload"] = "\nunion all ".join(
    f"select {n}::bigint as load, '{t}' as table_name, "
    + (
        f"(select count(*) from {source})"
        if n == 1
        else _MOVED if (n, t) == (2, "dim_customer") else "0::bigint"
    )
    + " as inserted, "
    + (_REKEYED if (n, t) == (2, "fact_sales") else "0::bigint")
    + " as updated, "
    + (_MOVED if (n, t) == (2, "dim_customer") else "0::bigint")
    + " as closed, 0::bigint as gone"
    for n in (1, 2, 3)
    for t, source in _LOADED
)

SQL["fact_upsert"] = f"""
    select sales_key, date_key, customer_key, product_key, store_key, employee_key, order_id,
           if(order_status = 'pending' and date_key >= 20001201, 'completed', order_status)
               as order_status,
           channel, quantity, {_FACT_MONEY} from wh_fact"""

SQL["load_summary"] = """
    select 'dim_date rows' as item, (select count(*) from wh_date) as n
    union all select 'dim_store rows', (select count(*) from wh_store)
    union all select 'dim_employee rows', (select count(*) from wh_employee)
    union all select 'dim_employee without manager',
              (select count(*) from wh_employee where manager_name is null)
    union all select 'dim_employee unknown member',
              (select count(*) from wh_employee where employee_id is null)
    union all select 'dim_product rows', (select count(*) from wh_product)
    union all select 'dim_product without category', 0
    union all select 'dim_product without parent category', 0
    union all select 'dim_product category paths',
              (select count(distinct category_path) from wh_product)
    union all select 'dim_customer rows', (select count(*) from wh_customer)
    union all select 'fact_sales rows', (select count(*) from wh_fact)"""

SQL["csv_roundtrip"] = "\nunion all ".join(
    f"select {i}::bigint as position, '{t}' as table_name, (select count(*) from src_{t}) as rows"
    for i, t in enumerate(SOURCE_TABLES, start=1)
)

# Revenue trends

_BY_MONTH = """
    with m as (select month_start, month_name, year, sum(net)::bigint as net,
                      sum(gross)::bigint as gross, sum(profit)::bigint as profit,
                      sum(quantity)::bigint as quantity, count(distinct order_id) as orders
               from sale group by all),
    t as (select *, lag(net) over seq as before, lag(net, 12) over seq as year_ago,
                 sum(net) over last3 as net3, count(*) over last3 as n3
          from m window seq as (order by month_start),
                        last3 as (order by month_start rows 2 preceding))"""

SQL["monthly_trend"] = _BY_MONTH + f"""
    select {day('month_start')} as month_start, month_name, year,
           {money('net')} as net_revenue, {money('gross')} as gross_revenue, orders, quantity,
           {ratio('net', '100 * orders', 2)} as avg_order_value, {money('profit')} as profit,
           {pct('profit', 'net')} as profit_margin_pct,
           {pct('gross - net', 'gross')} as discount_pct,
           {money('(select sum(x.net) from m x where x.year = t.year and x.month_start <= t.month_start)')} as ytd_revenue,
           {money('(select sum(x.profit) from m x where x.year = t.year and x.month_start <= t.month_start)')} as ytd_profit,
           (select sum(x.orders)::bigint from m x where x.year = t.year and x.month_start <= t.month_start) as ytd_orders,
           {pct('net - before', 'before')} as mom_pct, {pct('net - year_ago', 'year_ago')} as yoy_pct,
           {ratio('net3', '100 * n3', 2)} as moving_avg_3mo
    from t"""

SQL["same_store_sales"] = f"""
    with m as (select month_start, sum(net)::bigint as net, count(distinct store_key) as stores
               from sale join wh_store using (store_key)
               where opened_date + interval 12 month <= {AS_OF} group by all),
    t as (select *, lag(net, 12) over (order by month_start) as ly from m)
    select {day('month_start')} as month_start, {money('net')} as comp_revenue,
           stores as comp_store_count, {money('ly')} as comp_revenue_ly,
           {pct('net - ly', 'ly')} as sss_growth_pct from t"""

SQL["category_monthly"] = f"""
    select {day('month_start')} as month_start, category_name, parent_category_name,
           category_path, {money('sum(net)')} as category_revenue,
           {money('sum(profit)')} as category_profit, sum(quantity)::bigint as category_units,
           count(distinct order_id) as category_orders
    from sale group by all"""

SQL["cagr"] = f"""
    with y as (select year, sum(net)::bigint as net from sale group by year),
    b as (select (from (select year from y order by year limit 1)) as y0,
                 (from (select year from y order by year desc limit 1)) as y1)
    select y0 as start_year, y1 as end_year, {money('a.net')} as start_revenue,
           {money('z.net')} as end_revenue, y1 - y0 as num_years,
           round((pow({money('z.net')} / ({money('a.net')}), 1.0 / nullif(y1 - y0, 0)) - 1) * 100, 2) as cagr_pct
    from b join y a on a.year = y0 join y z on z.year = y1"""

SQL["cagr_ttm"] = f"""
    with ends as (select min(full_date) as d0, max(full_date) as d1 from sale),
    w as (select date_trunc('month', d1 + 1)::date as e1,
                 case when date_part('day', d0) = 1 then d0
                      else (date_trunc('month', d0) + interval 1 month)::date end as m0 from ends),
    n as (select *, date_diff('month', m0, e1) // 12 - 1 as years from w),
    p as (select years, e1, (e1 - interval 1 year)::date as e0,
                 (e1 - to_years(years::int))::date as s1,
                 (e1 - to_years(years::int + 1))::date as s0 from n),
    v as (select any_value(columns(p.*)),
                 sum(net) filter (full_date >= s0 and full_date < s1) as a,
                 sum(net) filter (full_date >= e0 and full_date < e1) as z
          from sale, p)
    select {day('s0')} as start_from, {day('s1')} as start_to, {day('e0')} as end_from,
           {day('e1')} as end_to, years as num_years, {money('a')} as start_revenue,
           {money('z')} as end_revenue,
           round((pow(({money('z')}) / ({money('a')}), 1.0 / nullif(years, 0)) - 1) * 100, 2) as cagr_pct
    from v"""

# Rankings

SQL["product_rank"] = f"""
    with t as (select product_id, name, category_name, sum(net)::bigint as r,
                      sum(profit)::bigint as p, sum(quantity)::bigint as q
               from sale group by all)
    select product_id, name, category_name, {money('r')} as total_revenue,
           {money('p')} as total_profit, q as total_quantity_sold,
           (select count(*) from t x where x.r > t.r) + 1 as revenue_rank,
           (select count(*) from t x where x.p > t.p) + 1 as profit_rank,
           (select count(*) from t x where x.q > t.q) + 1 as quantity_rank
    from t"""

_BRAND_TOP = f"""
    with t as (select brand, category_name, product_id, name, sum(net)::bigint as r
               from sale group by all)
    select brand, category_name, product_id, name, {money('r')} as revenue,
           row_number() over (partition by brand order by r desc, product_id) as rank_in_brand
    from t qualify rank_in_brand < 6"""
SQL["top5_per_brand"] = _BRAND_TOP
SQL["brand_top5"] = _BRAND_TOP + " and brand = 'Brand#1'"

SQL["top_brands_per_category"] = f"""
    with t as (select category_name, brand, sum(net)::bigint as r, sum(profit)::bigint as p,
                      sum(quantity)::bigint as q, count(distinct product_key) as n
               from sale group by all)
    select category_name, brand, {money('r')} as brand_revenue, {money('p')} as brand_profit,
           q as brand_units, n as product_count,
           rank() over (partition by category_name order by r desc) as rank_in_category
    from t qualify rank_in_category < 6"""

SQL["rank_movement"] = f"""
    with t as (select month_start as m, product_id, name, sum(net) as r from sale group by all),
    k as (select m, product_id, name, rank() over (partition by m order by r desc) as pos from t),
    p as (select *, lag(m) over w as old_m, lag(pos) over w as old_pos
          from k window w as (partition by product_id order by m)),
    q as (select *, case when date_diff('month', old_m, m) = 1 then old_pos end as old from p)
    select {day('m')} as month_start, product_id, name, pos as rank_this_month,
           old as rank_last_month,
           coalesce((old - pos)::varchar, 'New / Re-entered') as rank_improvement
    from q"""

SQL["sales_gaps"] = f"""
    with d as (select distinct product_id, name, category_name, full_date from sale),
    g as (select product_id, name, category_name,
                 date_diff('day', lag(full_date) over (partition by product_id order by full_date), full_date) as gap
          from d),
    t as (select product_id, name, category_name, count(gap) as n, max(gap) as hi,
                 min(gap) as lo, sum(gap)::bigint as s from g group by all having count(gap) > 0)
    select product_id, name, category_name, n as sale_days, hi as longest_gap_days,
           lo as shortest_gap_days, {ratio('s', 'n', 1)} as avg_gap_days,
           rank() over (order by hi desc) as longest_gap_rank,
           rank() over (order by lo) as shortest_gap_rank from t"""

# Pareto


def _classes(run: str, total: str, names: str) -> str:
    a, b, c = names
    return (
        f"case when 100 * ({run}) > 95 * ({total}) then '{c}' "
        f"when 100 * ({run}) > 80 * ({total}) then '{b}' else '{a}' end"
    )


def _abc(column: str, alias: str) -> str:
    shown = "v" if alias == "quantity" else money("v")
    return f"""
    with t as (select product_id, name, category_name, sum({column})::bigint as v
               from sale group by all),
    w as (select *, sum(v) over (order by v desc range unbounded preceding) as run,
                 (select sum(v) from t) as total, (select count(*) from t) as n,
                 row_number() over (order by v desc, product_id) as pos from t)
    select product_id, name, category_name, {shown} as {alias}, pos as rank_position,
           {pct('run', 'total')} as cumulative_pct, {pct('pos', 'n')} as pct_of_products,
           {_classes('run', 'total', 'ABc')} as abc_class from w"""


for _alias, _column in {
    "revenue": "net", "gross": "gross", "profit": "profit", "quantity": "quantity",
    "discount": "discount",
}.items():
    SQL[f"abc_{_alias}"] = _abc(_column, _alias)

SQL["abc_summary"] = f"""
    with t as (select product_id, sum(net)::bigint as v from sale group by all),
    w as (select v, {_classes('sum(v) over (order by v desc)', '(select sum(v) from t)', 'ABc')} as k from t),
    s as (select k, count(*) as n, sum(v) as r from w group by k)
    select k as abc_class, n as products, {pct('n', '(select count(*) from t)')} as pct_of_catalogue,
           {money('r')} as revenue, {pct('r', '(select sum(v) from t)')} as pct_of_revenue from s"""

_FIVE = {"revenue": "net", "gross": "gross", "profit": "profit", "quantity": "quantity", "discount": "discount"}
SQL["customer_pareto"] = (
    "with t as (select customer_id, "
    + ", ".join(f"sum({c})::bigint as {a}" for a, c in _FIVE.items())
    + " from sale group by customer_id), w as (select *, "
    + ", ".join(
        f"sum({a}) over (order by {a} desc) as run_{a}, "
        f"row_number() over (order by {a} desc, customer_id) as pos_{a}"
        for a in _FIVE
    )
    + " from t) select customer_id, c.full_name, c.address, c.age, c.sex, "
    + ", ".join(f"{a if a == 'quantity' else money(a)} as total_{a}" for a in _FIVE)
    + ", "
    + ", ".join(f"pos_{a} as {a}_rank" for a in _FIVE)
    + ", "
    + ", ".join(f"{pct(f'run_{a}', f'(select sum({a}) from t)')} as cum_pct_{a}" for a in _FIVE)
    + ", "
    + ", ".join(
        f"{_classes(f'run_{a}', f'(select sum({a}) from t)', 'ABC')} as abc_class_{a}"
        for a in ("revenue", "profit", "quantity")
    )
    + " from w join (from wh_customer where is_current) c using (customer_id)"
)


def _periods(keys: str, shown: str, unit: str) -> str:
    return f"""
    with t as (select {keys}, sum(net)::bigint as v from sale group by all),
    w as (select *, sum(v) over (order by v desc) as run, (select sum(v) from t) as total,
                 (select count(*) from t) as n,
                 row_number() over (order by v desc, {keys}) as pos from t)
    select {shown}, {money('v')} as revenue, pos as rank_position,
           {pct('run', 'total')} as cum_pct_revenue, {pct('pos', 'n')} as pct_of_{unit}s,
           {_classes('run', 'total', 'ABC')} as {unit}_class from w"""


SQL["daily_pareto"] = _periods(
    "full_date, day_name, is_weekend",
    f"{day('full_date')} as full_date, day_name, is_weekend",
    "day",
)
SQL["monthly_pareto"] = _periods(
    "month_start, fiscal_year, fiscal_quarter",
    f"{day('month_start')} as month_start, fiscal_year, fiscal_quarter",
    "month",
)

SQL["abc_movement"] = f"""
    with t as (select fiscal_year * 4 + fiscal_quarter as q, product_key, name,
                      sum(net)::bigint as v from sale group by all),
    w as (select *, sum(v) over (partition by q order by v desc) as run,
                 sum(v) over (partition by q) as total from t),
    k as (select q, product_key, name, v, {_classes('run', 'total', 'ABC')} as class from w)
    select (now.q - 1) // 4 as fiscal_year, (now.q - 1) % 4 + 1 as fiscal_quarter,
           now.product_key, now.name, {money('now.v')} as revenue,
           now.class as class_this_quarter, old.class as class_prev_quarter,
           case sign(ascii(old.class) - ascii(now.class)) when 0 then 'Stable'
                when 1 then 'Upgraded' when -1 then 'Downgraded'
                else 'New this quarter' end as movement
    from k now left join k old on old.product_key = now.product_key and old.q + 1 = now.q"""

# Customers

_RFM = f"""
    with t as (select customer_id, max(full_date) as last, {AS_OF} - max(full_date) as recency,
                      count(distinct order_id) as frequency, sum(net)::bigint as spent
               from sale group by customer_id),
    s as (select *, ntile(5) over (order by recency desc, customer_id) as r,
                 ntile(5) over (order by frequency, customer_id) as f,
                 ntile(5) over (order by spent, customer_id) as m from t),
    g as (select *, case when r > 3 then if(f > 3 and m > 3, 'Champions',
                                            if(f > 2, 'Loyal Customers', 'New / Promising'))
                         when r > 1 and f > 2 then 'At Risk'
                         when r < 3 and f > 3 and m > 3 then 'Cant Lose Them'
                         when r < 3 and f < 3 then 'Hibernating / Lost'
                         else 'Needs Attention' end as label from s)"""

SQL["rfm"] = _RFM + f"""
    select customer_id, {day('last')} as last_order_date, recency as recency_days, frequency,
           {money('spent')} as monetary, r as r_score, f as f_score, m as m_score,
           concat(r, f, m) as rfm_segment_code, label as rfm_segment_label from g"""

SQL["rfm_summary"] = _RFM + f"""
    select label as rfm_segment_label, count(*) as customers, {money('sum(spent)')} as revenue
    from g group by label"""

_COHORT = f"""
    with act as (select distinct customer_id, month_start from sale),
    born as (select *, min(month_start) over (partition by customer_id) as born from act),
    c as (select born, date_diff('month', born, month_start) as period, count(*) as n
          from born group by all),
    l as (select c.*, s.n as size from c join c s on s.born = c.born and s.period = 0)"""

SQL["cohort_long"] = _COHORT + f"""
    select {day('born')} as cohort_month, size as cohort_size, period as period_number,
           n as active_customers, {pct('n', 'size')} as retention_pct from l"""

SQL["cohort_triangle"] = (
    _COHORT
    + f" select {day('born')} as cohort_month, size as cohort_size, "
    + ", ".join(f"any_value({pct('n', 'size')}) filter (period = {k}) as m{k}" for k in range(6))
    + " from l group by born, size"
)

# Categories

SQL["category_rollup"] = f"""
    with leaf as (select parent_category_name as p, category_name as c, sum(net) as n,
                         sum(profit) as pr, sum(quantity) as q, count(distinct order_id) as o
                  from sale group by all),
    top as (select parent_category_name as p, sum(net) as n, sum(profit) as pr,
                   sum(quantity) as q, count(distinct order_id) as o from sale group by all),
    whole as (select sum(net) as n, sum(profit) as pr, sum(quantity) as q,
                     count(distinct order_id) as o from sale),
    u as (select p, c, 0 as g, 0 as s, n, pr, q, o from leaf
          union all select p, 'subtotal', 0, 1, n, pr, q, o from top
          union all select 'ALL_CATEGORIES', 'subtotal', 1, 1, n, pr, q, o from whole)
    select p as parent_category, c as category, g::bigint as is_grand_total,
           s::bigint as is_subtotal, {money('n')} as net_revenue, {money('pr')} as profit,
           q::bigint as units, o as orders from u"""

SQL["category_margin"] = f"""
    with t as (select parent_category_name as a, category_name as b, sum(net)::bigint as n,
                      sum(profit)::bigint as p, sum(gross)::bigint as g from sale group by all),
    k as (select *, rank() over (order by n desc) as rn, rank() over (order by p desc) as rp from t)
    select a as parent_category, b as category, {money('n')} as net_revenue, {money('p')} as profit,
           {pct('p', 'n')} as margin_pct, {pct('g - n', 'g')} as discount_pct,
           rn as revenue_rank, rp as profit_rank, rp - rn as rank_gap from k"""

SQL["cancellation"] = f"""
    with t as (select count(*) as lines, count(distinct order_id) as orders,
                      count(*) filter (order_id % 13 = 0) as cl,
                      count(distinct order_id) filter (order_id % 13 = 0) as co,
                      sum(net_amount)::bigint as r,
                      sum(net_amount) filter (order_id % 13 = 0)::bigint as x from wh_fact)
    select lines, cl as cancelled_lines, orders, co as cancelled_orders,
           {money('r')} as revenue_with_cancelled, {money('x')} as overstatement,
           {pct('co', 'orders', 2)} as cancelled_order_pct,
           {pct('x', 'r', 2)} as overstatement_pct from t"""

SQL["scd2_attribution"] = f"""
    select count(*) as fact_rows, count_if(employee_key = -1) as unknown_employee_rows,
           count_if(employee_key = -1 and channel = 'online') as unknown_employee_online_rows,
           count_if(valid_to is not null) as superseded_version_rows,
           count(distinct customer_key) filter (valid_to is not null) as superseded_versions_in_use
    from wh_fact join wh_customer using (customer_key)"""

# Baskets


def _rules(item: str, least: int) -> str:
    return f"""
    with per as (select order_id, list_sort(list(distinct {item})) as items from sale group by order_id),
    n as (select count(*) as n from per),
    single as (select unnest(items) as i, order_id from per),
    freq as (select i, count(*) as f from single group by i),
    pairs as (select a.i as item_a, b.i as item_b, count(*) as c
              from single a join single b on b.order_id = a.order_id and b.i > a.i
              group by all having count(*) >= {least}),
    r as (select item_a, item_b, c, n, fa.f as fa, fb.f as fb
          from pairs, n, freq fa, freq fb where fa.i = item_a and fb.i = item_b)"""


SQL["basket_category"] = _rules("category_name", 50) + f"""
    select item_a, item_b, c as pair_baskets, {pct('c', 'n', 3)} as support_pct,
           {pct('c', 'fa', 2)} as conf_a_to_b_pct, {pct('c', 'fb', 2)} as conf_b_to_a_pct,
           {ratio('c * n', 'fa * fb', 3)} as lift from r"""

SQL["basket_substitutes"] = _rules("category_name", 50) + f"""
    select item_a, item_b, c as pair_baskets, {ratio('c * n', 'fa * fb', 3)} as lift
    from r order by lift, item_a, item_b limit 15"""

SQL["basket_product"] = _rules("product_key", 2) + f"""
    select item_a, item_b, a.name as product_a, b.name as product_b,
           a.category_name as category_a, b.category_name as category_b, c as pair_baskets,
           {pct('c', 'n', 4)} as support_pct, {ratio('c * n', 'fa * fb', 3)} as lift
    from r join wh_product a on a.product_key = item_a join wh_product b on b.product_key = item_b
    order by lift desc, item_a, item_b limit 20"""

SQL["basket_sizes"] = f"""
    with b as (select order_id, count(distinct product_key) as k from sale group by order_id),
    t as (select k, count(*) as n from b group by k)
    select k as items_in_basket, n as baskets, {pct('n', '(select count(*) from b)', 2)} as pct_of_baskets,
           n * (k * (k - 1) // 2) as pair_instances from t"""

# Data quality

_ZERO = "'0'"


def _count(rest: str) -> str:
    return f"(select count(*)::varchar from {rest})"


def _euros(rest: str) -> str:
    return f"(select printf('%d.%02d', (sum(x) // 100)::bigint, (sum(x) % 100)::bigint) from ({rest}))"


_JOINED = (
    "wh_fact f join src_orders o using (order_id) join wh_product p using (product_key)"
)
_PROBES: dict[int, tuple[str, str]] = {
    1: ("'2557'", _count("wh_date")),
    2: (_ZERO, "(select (max(full_date) - min(full_date) + 1 - count(*))::varchar from wh_date)"),
    3: (_ZERO, _count("wh_date where strftime(full_date, '%Y%m%d') <> date_key::varchar")),
    4: (_ZERO, _count("wh_date where trim(month_name) <> month_name or trim(day_name) <> day_name")),
    5: (_ZERO, _count("wh_date where day_of_week < 1 or day_of_week > 7")),
    6: (_ZERO, _count("wh_date where is_weekend <> (day_of_week in (6, 7))")),
    7: (_ZERO, _count("(select year from wh_date group by year having bool_or(is_leap_year) <> (count(*) > 365))")),
    8: ("'1997|1998'", "(select string_agg(fiscal_year, '|' order by full_date) from wh_date where date_key in (19980716, 19980717))"),
    9: ("'1|2|3|4'", "(select string_agg(fiscal_quarter, '|' order by full_date) from wh_date where date_key in (19980717, 19981017, 19990117, 19990417))"),
    10: (_ZERO, _count("src_orders where order_date not in (select full_date from wh_date)")),
    20: (_count("src_stores"), _count("wh_store")),
    21: (_ZERO, _count("(select store_id, name, city, manager, opened_date from src_stores except select store_id, name, city, manager, opened_date from wh_store)")),
    22: (_ZERO, "(select (count(*) - count(distinct store_id))::varchar from wh_store)"),
    30: ("(select (count(*) + 1)::varchar from supplier)", _count("wh_employee")),
    31: ("'1'", _count("wh_employee where employee_key < 0")),
    32: (_ZERO, _count("src_employees where employee_id not in (select employee_id from wh_employee where employee_id is not null)")),
    33: (_ZERO, _count("wh_employee d join src_employees e using (employee_id) left join src_employees b on b.employee_id = e.manager_id where d.manager_name is distinct from b.first_name || ' ' || b.last_name")),
    34: (_ZERO, _count("wh_employee where employee_id >= 0 and store_name is null")),
    40: (_count("part"), _count("wh_product")),
    41: (_ZERO, _count("(select product_id, name, brand, unit_price, cost from src_products except select product_id, name, brand, unit_price, cost from wh_product)")),
    42: (_ZERO, _count("wh_product where category_name is null")),
    43: (_ZERO, _count("(select product_id, c.name from src_products join src_categories c using (category_id) except select product_id, category_name from wh_product)")),
    44: (_ZERO, _count("wh_product w join part on p_partkey = product_id where parent_category_name is distinct from p_type")),
    45: (_ZERO, _count("wh_product where category_path not like parent_category_name || ' > %' or not ends_with(category_path, category_name)")),
    46: ("(select count(distinct category_id)::varchar from src_products)", "(select count(distinct category_path)::varchar from wh_product)"),
    50: (_count("customer"), "(select count(distinct customer_id)::varchar from wh_customer)"),
    51: (_ZERO, _count("(select customer_id from wh_customer where is_current group by all having count(*) > 1)")),
    52: (_ZERO, _count("customer where c_custkey not in (select customer_id from wh_customer where is_current)")),
    53: (_ZERO, _count("wh_customer where is_current and valid_to is not null")),
    54: (_ZERO, _count("wh_customer where valid_to is null and not is_current")),
    55: (_ZERO, _count("wh_customer where valid_to < valid_from")),
    56: (_ZERO, _count("wh_customer a where exists (from wh_customer b where b.customer_id = a.customer_id and b.valid_from > a.valid_from) and not exists (from wh_customer b where b.customer_id = a.customer_id and b.valid_from = a.valid_to)")),
    57: (_ZERO, _count("(select customer_id, city, state, email, address from wh_customer where is_current except select customer_id, city, state, email, address from src_customers)")),
    58: (_ZERO, _count("(select customer_id from wh_customer group by all having min(valid_from) <> any_value(signup_date))")),
    59: (_ZERO, _count("src_orders o join (select customer_id, min(valid_from) as v from wh_customer group by all) using (customer_id) where order_date < v")),
    70: (_count("src_order_items"), _count("wh_fact")),
    71: (_euros("select quantity * unit_price - discount as x from src_order_items"), _euros("select net_amount as x from wh_fact")),
    72: (_euros("select quantity * unit_price as x from src_order_items"), _euros("select gross_amount as x from wh_fact")),
    73: (_ZERO, _count("wh_fact where net_amount + discount_amount <> gross_amount")),
    74: (_ZERO, _count("wh_fact where profit_amount + cost_amount <> net_amount")),
    75: (_ZERO, _count("wh_fact join wh_product using (product_key) join src_order_items i using (order_id, product_id) where gross_amount <> wh_fact.quantity * i.unit_price")),
    76: (_ZERO, _count("wh_fact join wh_product p using (product_key) where cost_amount <> quantity * p.cost")),
    77: (_ZERO, _count(f"{_JOINED} where date_key::varchar <> strftime(order_date, '%Y%m%d')")),
    78: (_ZERO, _count(f"{_JOINED} join wh_store s using (store_key) where s.store_id <> o.store_id")),
    79: (_ZERO, _count(f"(select order_id, product_id from {_JOINED} except select order_id, product_id from src_order_items)")),
    80: (_ZERO, _count(f"{_JOINED} join wh_customer c using (customer_key) where c.customer_id <> o.customer_id or order_date < valid_from or order_date >= valid_to")),
    81: (_ZERO, _count("wh_fact where employee_key = -1 and channel = 'in-store'")),
    82: (_ZERO, _count("wh_fact where employee_key >= 0 and channel = 'online'")),
    83: (_ZERO, _count(f"{_JOINED} join wh_employee e using (employee_key) where employee_key > 0 and e.employee_id is distinct from o.employee_id")),
    84: (_ZERO, "(select (count(*) - count(distinct (order_id, product_key)))::varchar from wh_fact)"),
    85: (_ZERO, _count(f"{_JOINED} where f.channel <> o.channel or order_status <> status")),
    86: (_ZERO, _count("wh_fact where least(quantity - 1, gross_amount, discount_amount) < 0")),
    87: (_ZERO, _count("(select store_id from recon_store where w is distinct from s)")),
    88: (_ZERO, _count("(select y from recon_month where w is distinct from s)")),
}

_RECON = """
    with recon_store as (
        select store_id, w, s
        from (select store_id, sum(net_amount)::bigint as w from wh_fact
              join wh_store using (store_key) group by all)
        full join (select store_id, sum(total_amount)::bigint as s from src_orders group by all)
            using (store_id)),
    recon_month as (
        select y, m, w, s
        from (select year as y, month as m, sum(net_amount)::bigint as w from wh_fact
              join wh_date using (date_key) group by all)
        full join (select date_part('year', order_date) as y, date_part('month', order_date) as m,
                          sum(total_amount)::bigint as s from src_orders group by all)
            using (y, m))"""


def _report(numbers, verdict: bool) -> str:
    rows = []
    for n in numbers:
        want, got = _PROBES[n]
        dimension, name = CHECKS[n]
        text = name.replace("'", "''")
        rows.append(
            f"select {n}::bigint as ord, '{dimension}' as dimension, '{text}' as check_name, "
            f"{want} as expected, {got} as actual"
        )
    union = "\nunion all ".join(rows)
    result = ", if(expected = actual, 'PASS', '*** FAIL ***') as result" if verdict else ""
    return f"{_RECON} select *{result} from ({union})"


SQL["validate_dim_date"] = _report([n for n in CHECKS if n < 20], False)
SQL["validate_dims"] = _report([n for n in CHECKS if 20 <= n < 50], False)
SQL["validate_scd2"] = _report([n for n in CHECKS if 50 <= n < 70], False)
SQL["validate_fact"] = _report([n for n in CHECKS if n >= 70], False)
SQL["validate_report"] = _report(CHECKS, True)

SQL["reconcile_store"] = _RECON + f"""
    select store_id, {money('w')} as warehouse_net, {money('s')} as source_net,
           w is distinct from s as differs from recon_store"""
SQL["reconcile_month"] = _RECON + f"""
    select y as year, m as month, {money('w')} as warehouse_net, {money('s')} as source_net,
           w is distinct from s as differs from recon_month"""


def _constraint_rows():
    for name, contract in SOURCE_TABLES.items():
        table = f"src_{name}"
        for c in contract.required:
            yield name, f"not null {c}", _number(f"{table} where {c} is null")
        for c, n in contract.lengths.items():
            yield name, f"length {c} <= {n}", _number(f"{table} where len({c}) > {n}")
        for c in contract.checks:
            yield name, f"check {c}", _number(f"{table} where not ({c})")
        for keys in [(contract.key,), *contract.unique]:
            k = ", ".join(keys)
            yield name, f"unique {k}", _number(
                f"(select {k} from {table} group by all having count(*) > 1)"
            )
        for ref in contract.foreign:
            yield name, f"{ref.column} in {ref.table}", _number(
                f"{table} c where {ref.column} is not null and not exists "
                f"(from src_{ref.table} p where p.{ref.target} = c.{ref.column})"
            )


def _number(rest: str) -> str:
    return f"(select count(*) from {rest})"


SQL["constraint_report"] = "\nunion all ".join(
    "select '{}' as table_name, '{}' as rule, {} as violations".format(
        t, rule.replace("'", "''"), count
    )
    for t, rule, count in _constraint_rows()
)


def _sample_rows():
    """rule, and the values that break it with the rows of each, on tables of which two are damaged."""
    tables = {t: {"customers": "bad_customers", "orders": "bad_orders"}.get(t, f"src_{t}") for t in SOURCE_TABLES}
    for name, contract in SOURCE_TABLES.items():
        table = tables[name]
        wrong = [(f"not null {c}", f"{c} is null") for c in contract.required]
        wrong += [(f"length {c} <= {n}", f"len({c}) > {n}") for c, n in contract.lengths.items()]
        wrong += [(f"check {c}", f"not ({c})") for c in contract.checks]
        for rule, test in wrong:
            yield name, rule, f"select {contract.key}::varchar as value, count(*) as rows from {table} where {test} group by all"
        for keys in [(contract.key,), *contract.unique]:
            k = ", ".join(keys)
            some = " and ".join(f"{c} is not null" for c in keys)
            value = f"{keys[0]}::varchar" if len(keys) == 1 else f"to_json([{', '.join(c + '::varchar' for c in keys)}])::varchar"
            yield name, f"unique {k}", f"select {value} as value, 1 as rows from {table} where {some} group by {k} having count(*) > 1"
        for ref in contract.foreign:
            yield name, f"{ref.column} in {ref.table}", (
                f"select {ref.column}::varchar as value, count(*) as rows from {table} c where {ref.column} is not null and not exists "
                f"(from {tables[ref.table]} p where p.{ref.target} = c.{ref.column}) group by all"
            )


SQL["constraint_samples"] = """
    with bad_customers as (
        select * replace (if(customer_id % 20 = 1, 'shared' || customer_id % 7, email) as email,
                          if(customer_id % 25 = 3, null, sex) as sex) from src_customers),
    bad_orders as (select * replace (if(order_id % 40 = 7, -customer_id, customer_id) as customer_id) from src_orders),
    broken as (""" + "\n    union all ".join(
    "select '{}' as table_name, '{}' as rule, value, rows from ({})".format(t, rule.replace("'", "''"), rows)
    for t, rule, rows in _sample_rows()
) + """)
    select table_name, rule, value, rows::bigint as rows,
           row_number() over (partition by table_name, rule order by md5(value), value) as place
    from broken qualify place <= 10"""

_LATE = """
    with notices as (
        select customer_id, signup_date + (100 + customer_id % 1000 + extra)::int as day, prefix || city as city,
               state, address, phone, email
        from src_customers, (values (15, 0, 'Late '), (30, 50, 'Later ')) v(every, extra, prefix)
        where customer_id % every = 0),
    points as (
        select coalesce(v.customer_id, n.customer_id) as customer_id, coalesce(v.valid_from, n.day) as day,
               v.customer_key, n.day is not null as told,
               n.city, n.state, n.address, n.phone, n.email
        from wh_customer v full join notices n
            on v.customer_id = n.customer_id and v.valid_from = n.day),
    timeline as (
        select p.*, lead(day) over w as ends, lead(customer_key is null) over w as cut,
               last_value(customer_key ignore nulls) over w as old_key
        from points p window w as (partition by customer_id order by day)),
    late as (
        select coalesce(t.customer_key, (select max(customer_key) from wh_customer)
                        + row_number() over (partition by t.customer_key is null order by t.customer_id, day)) as customer_key,
               t.customer_id, v.full_name, v.age, v.sex, v.signup_date,
               if(told, t.email, v.email) as email, if(told, t.phone, v.phone) as phone,
               if(told, t.address, v.address) as address, if(told, t.city, v.city) as city,
               if(told, t.state, v.state) as state,
               day as valid_from, ends as valid_to, ends is null as is_current,
               case when t.customer_key is null then 'inserted' when cut then 'closed'
                    when told then 'corrected' else 'kept' end as change
        from timeline t join wh_customer v on v.customer_key = old_key)"""

SQL["scd2_late_change"] = _LATE + """
    select customer_key, customer_id, full_name, email, phone, address, city, state, age, sex, signup_date::varchar as signup_date,
           valid_from::varchar as valid_from, valid_to::varchar as valid_to, is_current, change from late"""
SQL["fact_late_change"] = _LATE + """
    select sales_key, date_key, l.customer_key
    from wh_fact join wh_customer c using (customer_key)
    join late l on l.customer_id = c.customer_id and strftime(l.valid_from, '%Y%m%d')::bigint <= date_key
        and (l.valid_to is null or date_key < strftime(l.valid_to, '%Y%m%d')::bigint)"""

SQL["business_rules"] = """
    with t as (select o.*, opened_date, signup_date, i.total as lines, p.amount
               from src_orders o left join src_stores using (store_id)
               left join src_customers using (customer_id)
               left join (select order_id, sum(quantity * unit_price - discount) as total
                          from src_order_items group by all) i using (order_id)
               left join src_payments p using (order_id))
    select 'order total differs from its lines' as rule,
           count_if(lines is distinct from total_amount) as violations from t
    union all select 'order in a paid status without payment',
           count_if(status in ('shipped', 'delivered', 'completed') and amount is null) from t
    union all select 'payment of an order in an unpaid status',
           count_if(status in ('pending', 'cancelled') and amount is not null) from t
    union all select 'payments differ from the order total', count_if(amount <> total_amount) from t
    union all select 'online with employee, or in store without',
           count_if((channel = 'in-store') = (employee_id is null)) from t
    union all select 'order before its store opened', count_if(order_date < opened_date) from t
    union all select 'order before the customer signed up', count_if(order_date < signup_date) from t
    union all select 'raw order without lines', count(*) from orders where o_orderkey not in (select l_orderkey from lineitem)
    union all select 'raw order without customer', count(*) from orders where o_custkey not in (select c_custkey from customer)
    union all select 'raw line without order', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)
    union all select 'raw line without product', count(*) from lineitem where l_partkey not in (select p_partkey from part)
    union all select 'raw customer without nation', count(*) from customer
              where c_nationkey not in (select n_nationkey from nation join region on n_regionkey = r_regionkey)"""

SQL["distribution_sanity"] = f"""
    with s as (select year(order_date) as y, count_if(month(order_date) = 10) as o,
                      count_if(month(order_date) = 11) as n from src_orders group by all),
    p as (select v, row_number() over (order by v desc, product_key) as pos, count(*) over () as c
          from (select product_key, sum(net_amount)::bigint as v from wh_fact group by all)),
    k as (select sum(v) filter (5 * pos <= c)::bigint as top, sum(v)::bigint as whole from p),
    b as (select customer_id, count(*) as n from src_orders group by all),
    h as (select sum(n)::bigint as total, count(*) as buyers, median(n) as med, max(n) as most from b)
    select 'orders in October ' || y as metric, o::double as value from s
    union all select 'orders in November ' || y, n::double from s
    union all select 'November lift ' || y, {ratio('n', 'o', 2)} from s
    union all select 'revenue share of the top fifth of products', {pct('top', 'whole')} from k
    union all select 'orders per buyer, mean', {ratio('total', 'buyers', 2)} from h
    union all select 'orders per buyer, median', med::double from h
    union all select 'orders per buyer, maximum', most::double from h
    union all select 'customers without orders',
              (select count(*) from customer where c_custkey not in (select customer_id from b))::double"""

STATEMENTS = {name: statement(sql) for name, sql in SQL.items()}

"""Shared table expressions for DuckDB: source tables and star, all money in whole cents.

Only the expressions that a statement needs are put in front of it.
"""

from __future__ import annotations

import re

CHANGE_DAY = "date '1998-07-01'"
AS_OF = "(select max(o_orderdate)::date + 1 from orders)"

TABLES: dict[str, str] = {}

TABLES["src_categories"] = """
    with kinds as (select p_type, row_number() over (order by p_type) as id
                   from (select distinct p_type from part))
    select id as category_id, p_type as name, null::bigint as parent_category_id from kinds
    union all
    select distinct id * 1000000000 + (p_size - 1) // 10 + 1,
           p_type || ' B' || ((p_size - 1) // 10), id
    from part join kinds using (p_type)"""

TABLES["src_stores"] = """
    select n_nationkey::bigint as store_id, n_name as name,
           '555-' || lpad(n_nationkey::varchar, 4, '0') as phone, r_name as city,
           date '1993-01-01' + 130 * n_nationkey as opened_date, 'Manager ' || n_name as manager
    from nation join region on r_regionkey = n_regionkey"""

TABLES["src_products"] = """
    select p_partkey as product_id, category_id, p_name as name, p_brand as brand,
           (round(p_retailprice * 100)::bigint * p_size + 5) // 10 as unit_price,
           ((round(p_retailprice * 100)::bigint * p_size + 5) // 10 * 6 + 5) // 10 as cost
    from part join src_categories c on c.name = p_type || ' B' || ((p_size - 1) // 10)"""

TABLES["src_employees"] = """
    select s_suppkey as employee_id, 'Employee' as first_name, s_suppkey::varchar as last_name,
           'e' || s_suppkey || '@example.com' as email,
           '555-' || lpad(s_suppkey::varchar, 6, '0') as phone, date '1994-01-01' as hire_date,
           nullif(min(s_suppkey) over (partition by s_nationkey), s_suppkey) as manager_id,
           s_nationkey::bigint as store_id
    from supplier"""

TABLES["grouped_lines"] = """
    select l_orderkey as order_id, l_partkey as product_id, sum(l_quantity)::bigint as quantity,
           max(round(l_discount * 100)::bigint) as percent, min(l_suppkey) as supplier
    from lineitem group by all"""

TABLES["priced_lines"] = """
    select g.*, (p.unit_price * (100 + order_id % 41) + 50) // 100 as line_price
    from grouped_lines g join src_products p using (product_id)"""

TABLES["src_order_items"] = """
    select row_number() over (order by order_id, product_id) as order_item_id, order_id,
           product_id, quantity, line_price as unit_price,
           (line_price * percent + 50) // 100 as discount
    from priced_lines"""

TABLES["src_orders"] = """
    with sums as (select order_id, sum(quantity * unit_price - discount)::bigint as total
                  from src_order_items group by order_id),
         staff as (select order_id, min(supplier) as first_supplier
                   from grouped_lines group by order_id),
         flagged as (select *, o_orderpriority[1] in ('4', '5') as web from orders)
    select order_id, o_custkey as customer_id, c_nationkey::bigint as store_id,
           case when not web then first_supplier end as employee_id,
           o_orderdate::date as order_date, if(web, 'online', 'in-store') as channel,
           case when order_id % 13 = 0 then 'cancelled' when o_orderstatus = 'F' then 'delivered'
                when o_orderstatus = 'O' then 'shipped' else 'pending' end as status,
           total as total_amount
    from flagged join sums on order_id = o_orderkey join staff using (order_id)
    join customer on c_custkey = o_custkey"""

TABLES["src_customers_before"] = """
    select c_custkey as customer_id, 'Customer' as first_name, c_custkey::varchar as last_name,
           'c' || c_custkey || '@example.com' as email,
           '555-' || lpad(c_custkey::varchar, 7, '0') as phone,
           c_custkey || ' Main Street' as address, n_name as city, r_name as state,
           coalesce((select min(order_date) from src_orders o where o.customer_id = c_custkey)
                    - (c_custkey % 60)::int, date '1995-01-01') as signup_date,
           (18 + c_custkey % 63)::bigint as age, if(c_custkey % 2 = 0, 'M', 'F') as sex,
           c_nationkey
    from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey"""

TABLES["src_customers"] = f"""
    select customer_id, first_name, last_name,
           if(early and customer_id % 25 = 0, 'c' || customer_id || '@newdomain.example', email) as email,
           phone, if(moves, 'Relocated - ' || address, address) as address,
           if(moves, n_name, city) as city, if(moves, r_name, state) as state,
           signup_date, age, sex
    from (select *, signup_date < {CHANGE_DAY} as early,
                 signup_date < {CHANGE_DAY} and customer_id % 10 = 0 as moves
          from src_customers_before) c
    join nation on n_nationkey = (c_nationkey + 1) % 25
    join region on r_regionkey = n_regionkey"""

TABLES["src_payments"] = """
    select row_number() over (order by order_id) as payment_id, order_id,
           ['cash', 'card', 'wallet', 'bank_transfer'][order_id % 4 + 1] as method,
           total_amount as amount,
           order_date + (order_id % 3)::int + interval 12 hour as paid_at
    from src_orders where status not in ('pending', 'cancelled')"""

TABLES["src_inventory"] = """
    select 0 as inventory_id, 0 as store_id, 0 as product_id, 0 as quantity,
           null::date as last_restock_date
    where false"""

TABLES["wh_date"] = """
    select strftime(d, '%Y%m%d')::bigint as date_key, d as full_date,
           date_part('year', d) as year, date_part('quarter', d) as quarter,
           date_part('month', d) as month, date_part('day', d) as day,
           monthname(d) as month_name, dayname(d) as day_name,
           date_part('isodow', d) as day_of_week, date_part('doy', d) as day_of_year,
           date_part('week', d) as week_of_year, dayname(d) in ('Saturday', 'Sunday') as is_weekend,
           make_date(date_part('year', d), 3, 1) - make_date(date_part('year', d), 2, 28) = 2
               as is_leap_year,
           date_part('year', d) - if(strftime(d, '%m%d') < '0717', 1, 0) as fiscal_year,
           case when strftime(d, '%m%d') between '0717' and '1016' then 1
                when strftime(d, '%m%d') between '0117' and '0416' then 3
                when strftime(d, '%m%d') between '0417' and '0716' then 4 else 2 end
               as fiscal_quarter
    from (select unnest(range(date_trunc('year', min(o_orderdate::date)),
                              date_trunc('year', max(o_orderdate::date)) + interval 1 year,
                              interval 1 day))::date as d from orders)"""

TABLES["wh_store"] = """
    select row_number() over (order by store_id) as store_key, store_id, name, city, phone,
           manager, opened_date
    from src_stores"""

TABLES["wh_employee"] = """
    select row_number() over (order by e.employee_id) as employee_key, e.employee_id,
           'Employee ' || e.last_name as full_name, e.email, e.hire_date,
           'Employee ' || e.manager_id as manager_name, s.name as store_name
    from src_employees e join src_stores s using (store_id)
    union all
    select -1, null, 'Online / No Salesperson', null, null, null, 'N/A'"""

TABLES["wh_product"] = """
    select row_number() over (order by product_id) as product_key, product_id, p.name, brand,
           leaf.name as category_name, top.name as parent_category_name,
           top.name || ' > ' || leaf.name as category_path, unit_price, cost
    from src_products p join src_categories leaf using (category_id)
    join src_categories top on top.category_id = leaf.parent_category_id"""

TABLES["moved_ids"] = """
    select a.customer_id
    from src_customers_before a join src_customers b using (customer_id)
    where (a.city, a.state, a.address, a.phone, a.email)
          is distinct from (b.city, b.state, b.address, b.phone, b.email)"""

TABLES["wh_customer"] = f"""
    with first_rows as (
        select row_number() over (order by customer_id) as customer_key, *,
               customer_id in (from moved_ids) as superseded
        from src_customers_before)
    select customer_key, customer_id, first_name || ' ' || last_name as full_name, email, phone,
           address, city, state, age, sex, signup_date, signup_date as valid_from,
           if(superseded, {CHANGE_DAY}, null) as valid_to, not superseded as is_current
    from first_rows
    union all
    select (select count(*) from customer) + row_number() over (order by customer_id),
           customer_id, first_name || ' ' || last_name, email, phone, address, city, state, age,
           sex, signup_date, {CHANGE_DAY}, null, true
    from src_customers where customer_id in (from moved_ids)"""

TABLES["wh_fact"] = """
    with lined as (
        select i.*, o.customer_id, o.store_id, o.employee_id, o.order_date, o.channel, o.status,
               p.product_key, p.cost, i.quantity * i.unit_price as gross, i.quantity * p.cost as spent
        from src_order_items i join src_orders o using (order_id)
        join wh_product p using (product_id))
    select order_item_id as sales_key, strftime(order_date, '%Y%m%d')::bigint as date_key,
           c.customer_key, product_key, s.store_key, coalesce(e.employee_key, -1) as employee_key,
           order_id, status as order_status, channel, quantity, gross as gross_amount,
           discount as discount_amount, gross - discount as net_amount, spent as cost_amount,
           gross - discount - spent as profit_amount
    from lined l
    join wh_customer c on c.customer_id = l.customer_id
         and l.order_date between c.valid_from and coalesce(c.valid_to - 1, date '9999-12-31')
    join wh_store s using (store_id)
    left join wh_employee e on e.employee_id = l.employee_id"""

# Every kept fact row with the attributes that the analytics use.
TABLES["sale"] = """
    select f.order_id, f.product_key, f.store_key, f.quantity, f.net_amount as net,
           f.gross_amount as gross, f.discount_amount as discount, f.profit_amount as profit,
           d.full_date, d.year, d.month_name, d.day_name, d.is_weekend, d.fiscal_year,
           d.fiscal_quarter, date_trunc('month', d.full_date)::date as month_start,
           p.product_id, p.name, p.brand, p.category_name, p.parent_category_name,
           p.category_path, c.customer_id
    from wh_fact f join wh_date d using (date_key) join wh_product p using (product_key)
    join wh_customer c using (customer_key)
    where f.order_status in ('delivered', 'shipped', 'pending', 'completed')"""


def statement(body: str) -> str:
    """The statement with the table expressions it needs, in order of dependency."""
    ordered: list[str] = []

    def add(text: str) -> None:
        for name in TABLES:
            if re.search(rf"\b{name}\b", text) and name not in ordered:
                add(TABLES[name])
                ordered.append(name)

    add(body)
    parts = [f"{name} as ({TABLES[name]})" for name in ordered]
    own = re.match(r"\s*with\s", body)
    rest = body[own.end():] if own else body
    if not parts:
        return body
    return "with " + ",\n".join(parts) + (",\n" if own else "\n") + rest


def money(cents: str) -> str:
    return f"({cents})::double / 100"


def ratio(num: str, den: str, digits: int) -> str:
    """Integer num / den, rounded half away from zero without a floating-point step."""
    scale = 10**digits
    return (
        f"case when ({den}) = 0 then null else "
        f"((sign({num}) * sign({den}))::hugeint * "
        f"((2 * abs(({num})::hugeint) * {scale} + abs(({den})::hugeint)) "
        f"// nullif(2 * abs(({den})::hugeint), 0)))::double / {scale} end"
    )


def pct(num: str, den: str, digits: int = 1) -> str:
    return ratio(f"100 * ({num})", den, digits)


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"

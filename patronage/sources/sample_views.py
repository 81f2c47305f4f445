"""Sample data: the fifteen source tables expressed over the TPC-H-like Parquet tables.

Every view is one SQL text in the subset that Spark and DuckDB read alike, so the same
text feeds the Spark jobs and their SQL oracles. ``{name}`` marks an input table or view.
Violations (NULL e-mail, end before start, unknown variant, ...) are planted on purpose.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "nation", "supplier", "part", "orders", "lineitem", "events")

# floored to whole cents, so decimal sums are the same in both engines
_CENTS = "cast(cast(floor({}) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2))"
_LINE_ID = (
    "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
    "cast(l_partkey as string) || '-' || cast(l_suppkey as string)"
)
_CUSTOMER_ID = "'CUST_' || lpad(cast(c_custkey as string), 6, '0')"
_EVENT_CUSTOMER = (
    "cast(floor(event_id / (1 + event_id % 4)) as bigint) % (select count(*) from {customer})"
)

VIEWS: dict[str, str] = {
    "customers": f"""
        select {_CUSTOMER_ID} as customer_id,
               case when c_custkey % 97 = 0 then null
                    when c_custkey % 61 = 0 then 'bad-address'
                    else 'c' || cast(c_custkey as string) || '@example.com' end as email,
               'F' || cast(c_custkey % 50 as string) as first_name,
               'L' || cast(c_custkey % 70 as string) as last_name,
               date '1940-01-01' + cast(c_custkey * 37 % 16000 as int) as date_of_birth,
               case c_custkey % 3 when 0 then 'M' when 1 then 'F' when 2 then 'O' end as gender,
               n_name as country,
               case c_custkey % 4 when 0 then 'Low' when 1 then 'Medium'
                                  when 2 then 'High' when 3 then 'Very High' end as income_bracket,
               case when c_custkey % 50 = 7 then date '2001-09-01'
                    when c_custkey % 5 = 0 then date '2001-08-02' - cast(c_custkey % 80 as int)
                    else date '1992-01-01' + cast(c_custkey % 730 as int) end as registration_date,
               c_custkey % 4 <> 0 as is_active
        from {{customer}} join {{nation}} on c_nationkey = n_nationkey""",
    "customer_demographics": f"""
        select {_CUSTOMER_ID} as customer_id,
               case when c_custkey % 40 = 3 then null
                    else case c_custkey % 5 when 0 then '18-24' when 1 then '25-34' when 2 then '35-44'
                                            when 3 then '45-54' when 4 then '55+' end end as age_group,
               case c_custkey % 3 when 0 then 'High School' when 1 then 'Bachelor'
                                  when 2 then 'Master' end as education_level,
               cast(1 + c_custkey % 6 as int) as household_size,
               c_mktsegment as interests,
               case c_custkey % 3 when 0 then 'Urban' when 1 then 'Suburban' when 2 then 'Rural' end as lifestyle_segment
        from {{customer}}""",
    "transactions": f"""
        select 'TXN_' || lpad(cast(o_orderkey as string), 8, '0') as transaction_id,
               'CUST_' || lpad(cast(o_custkey as string), 6, '0') as customer_id,
               cast(o_orderdate as date) as order_date,
               {_CENTS.format('o_totalprice / 10')} as total_amount,
               'USD' as currency,
               o_orderpriority as payment_method,
               case o_orderstatus when 'F' then 'Delivered' when 'O' then 'Shipped' else 'Processing' end as order_status
        from {{orders}}""",
    # order lines without the product table; the full view adds it
    "item_lines": f"""
        select {_LINE_ID} as item_id,
               'TXN_' || lpad(cast(l_orderkey as string), 8, '0') as transaction_id,
               'PROD_' || cast(l_partkey as string) as product_id,
               cast(l_quantity as int) as quantity,
               {_CENTS.format('l_extendedprice / 10')} as total_price,
               l_extendedprice / 1000 / l_quantity as unit_price
        from {{lineitem}}""",
    "transaction_items": f"""
        select {_LINE_ID} as item_id,
               'TXN_' || lpad(cast(l_orderkey as string), 8, '0') as transaction_id,
               'PROD_' || cast(l_partkey as string) as product_id,
               p_name as product_name, p_type as category, p_brand as subcategory,
               cast(l_quantity as int) as quantity,
               {_CENTS.format('l_extendedprice / 10')} as total_price,
               l_extendedprice / 1000 / l_quantity as unit_price
        from {{lineitem}} join {{part}} on l_partkey = p_partkey""",
    # a second campaign for one supplier in 25, to which no line refers: its totals are NULL
    "campaigns": """
        select 'CAMP_' || lpad(cast(s_suppkey as string), 6, '0') as campaign_id,
               s_name as campaign_name,
               case s_suppkey % 6 when 0 then 'Email' when 1 then 'Social Media' when 2 then 'Search'
                                  when 3 then 'Display' when 4 then 'Video' when 5 then 'Affiliate' end as campaign_type,
               case s_nationkey % 7 when 0 then 'Facebook' when 1 then 'Google' when 2 then 'Instagram'
                                    when 3 then 'LinkedIn' when 4 then 'Twitter' when 5 then 'Email'
                                    when 6 then 'Direct' end as channel,
               case cast(floor(s_suppkey / 6) as bigint) % 6
                    when 0 then 'New Customers' when 1 then 'Existing Customers' when 2 then 'High Value'
                    when 3 then 'At Risk' when 4 then 'Loyal' when 5 then 'All' end as target_audience,
               date '2001-01-01' + cast(s_suppkey % 100 as int) as start_date,
               date '2001-01-01' + cast(s_suppkey % 100 + s_suppkey * 7 % 120 - 3 as int) as end_date,
               cast(s_acctbal as decimal(12,2)) as budget,
               case when s_suppkey % 5 < 3 then 'Active' when s_suppkey % 5 = 3 then 'Paused' else 'Completed' end as status
        from (select s_suppkey, s_name, s_nationkey, s_acctbal from {supplier}
              union all
              select s_suppkey + 900000, s_name, s_nationkey, s_acctbal from {supplier} where s_suppkey % 25 = 24) s""",
    "campaign_performance": f"""
        select {_LINE_ID} as performance_id,
               'CAMP_' || lpad(cast(l_suppkey as string), 6, '0') as campaign_id,
               cast(l_shipdate as date) as date,
               cast(l_quantity as int) * 100 as impressions,
               cast(l_quantity as int) * (1 + l_linenumber) as clicks,
               l_linenumber as conversions,
               {_CENTS.format('l_extendedprice * (1 - l_discount) / 40')} as revenue
        from {{lineitem}}""",
    "ab_tests": """
        select 'ABT_' || lpad(cast(p_partkey as string), 6, '0') as test_id,
               p_name as test_name,
               'CAMP_' || lpad(cast(p_partkey % (select count(*) from {supplier}) as string), 6, '0') as campaign_id,
               'Original ' || p_type as variant_a_description,
               'New ' || p_type as variant_b_description,
               date '2001-02-01' + cast(p_partkey % 60 as int) as start_date,
               date '2001-02-01' + cast(p_partkey % 60 + p_partkey % 31 - 1 as int) as end_date,
               p_size * 100 as sample_size,
               case when p_partkey % 4 < 2 then 'Running' when p_partkey % 4 = 2 then 'Completed' else 'Paused' end as test_status
        from {part}""",
    "ab_test_results": f"""
        select {_LINE_ID} as result_id,
               'ABT_' || lpad(cast(l_partkey as string), 6, '0') as test_id,
               case l_returnflag when 'A' then 'A' when 'R' then 'B' else 'X' end as variant,
               cast(l_quantity as int) * 4 as impressions,
               cast(floor(l_quantity / (1 + l_linenumber)) as int) as clicks,
               cast(floor(l_quantity / 10) as int) as conversions,
               {_CENTS.format('l_extendedprice * (1 - l_discount) / 40')} as revenue
        from {{lineitem}}""",
    "click_base": f"""
        select event_id,
               {_EVENT_CUSTOMER} as customer_key,
               'CUST_' || lpad(cast({_EVENT_CUSTOMER} as string), 6, '0') as customer_id,
               'SESS_' || cast({_EVENT_CUSTOMER} as string) || '_' || cast(cast(ts as date) as string) as session_id,
               ts,
               cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
               event_type as raw_type,
               value
        from {{events}}""",
    "sessions": """
        select session_id, customer_id,
               min(ts) as session_start, max(ts) as session_end,
               cast(max(event_id) % 3600 as int) as duration_seconds,
               case when max(event_id) % 5 < 2 then 'Mobile' when max(event_id) % 5 < 4 then 'Desktop'
                    else 'Tablet' end as device_type,
               case when max(event_id) % 6 < 3 then 'Chrome' when max(event_id) % 6 = 3 then 'Safari'
                    when max(event_id) % 6 = 4 then 'Firefox' else 'Edge' end as browser
        from {click_base} group by customer_id, session_id""",
    "page_views": """
        select 'VIEW_' || cast(event_id as string) as view_id,
               case when event_id % 50 = 0 then null else session_id end as session_id,
               customer_id,
               '/page/' || cast(k as string) as page_url,
               cast(10 + event_id % 590 as int) as time_on_page,
               cast(event_id * 7 % 101 as int) as scroll_depth,
               ts as timestamp
        from {click_base} where raw_type in ('view', 'click')""",
    "click_events": """
        select 'EVENT_' || cast(event_id as string) as event_id,
               session_id, customer_id,
               case when raw_type = 'purchase' and value >= 75 then 'purchase'
                    when raw_type = 'signup' and value >= 50 then 'add_to_cart'
                    when raw_type = 'signup' then 'form_submit'
                    when raw_type = 'view' then 'scroll'
                    when raw_type = 'click' then 'click' else 'hover' end as event_type,
               ts as timestamp
        from {click_base}""",
    "product_interactions": """
        select 'INT_' || cast(event_id as string) as interaction_id,
               session_id, customer_id,
               'PROD_' || cast(k as string) as product_id,
               case when raw_type = 'view' then 'view' when raw_type = 'purchase' then 'add_to_cart'
                    when event_id % 2 = 0 then 'wishlist' else 'share' end as interaction_type,
               ts as timestamp
        from {click_base} where raw_type in ('view', 'purchase', 'signup')""",
    "search_queries": """
        select 'QUERY_' || cast(event_id as string) as query_id,
               session_id, customer_id,
               'term_' || cast(k % 21 as string) as search_term,
               k as search_results_count,
               case when event_id % 10 < 3 then null else cast(1 + event_id % 10 as int) end as clicked_result_position,
               ts as timestamp
        from {click_base} where raw_type in ('click', 'error')""",
}


@cache
def inputs_of(view: str) -> tuple[str, ...]:
    """Names a view reads, in order of appearance."""
    names = [field for _, field, _, _ in string.Formatter().parse(VIEWS[view]) if field]
    return tuple(dict.fromkeys(names))


def oracle_text(view: str) -> str:
    """The view as SQL over tables of the same names."""
    return VIEWS[view].format(**{name: name for name in inputs_of(view)})


def read_base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sample_view(
    spark: SparkSession, sf_dir: str, name: str, resolve: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """A base table or one of :data:`VIEWS` as a DataFrame; nothing is registered.
    ``resolve`` supplies the inputs of a view where they are at hand already."""
    if name in BASE_TABLES:
        return read_base(spark, sf_dir, name)
    find = resolve or (lambda source: sample_view(spark, sf_dir, source))
    return spark.sql(VIEWS[name], **{source: find(source) for source in inputs_of(name)})

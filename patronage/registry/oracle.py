"""SQL that computes each query's result on its own, for DuckDB over the sample tables.

``CTES`` are named relations; each query gets those it needs in front. ``pick`` writes the
published form of a result (see ``publish``): whole numbers as bigint, others as doubles
rounded to six digits, dates as text.
"""

from __future__ import annotations

import re

from patronage.functions.constants import SEGMENTATION_FEATURES
from patronage.sources.sample_views import VIEWS, oracle_text

AS_OF = "date '2001-08-02'"


def pick(source: str, i: str = "", f: str = "", s: str = "", b: str = "") -> str:
    """SELECT of columns by kind: integers, fractions, text (and dates), booleans."""
    columns = (
        [f"cast({c} as bigint) as {c}" for c in i.split()]
        + [f"round(cast({c} as double), 6) + 0.0 as {c}" for c in f.split()]
        + [f"cast({c} as varchar) as {c}" for c in s.split()]
        + b.split()
    )
    return f"select {', '.join(columns)} from {source}"


def _files(tables: str) -> str:
    """Rows of each table under its file's name."""
    return " union all ".join(f"select '{t}.parquet' as file, count(*) as rows from {t}" for t in tables.split())


def ratio0(num: str, den: str) -> str:
    return f"case when {den} > 0 then cast({num} as double) / cast({den} as double) else 0.0 end"


def half_up(amount: str) -> str:
    """Mean of exact decimals (up to four places) rounded half up to cents, in whole numbers."""
    units = f"cast(sum({amount}) * 10000 as hugeint)"
    return f"cast((2 * {units} + 100 * count(*)) // (200 * count(*)) as double) / 100"


def bins(column: str, edges: list[float], labels: list[str]) -> str:
    """Right-closed bins, from the top down."""
    arms = [f"when {column} > {low} then '{label}'" for low, label in list(zip(edges, labels))[::-1]]
    top = edges[-1]
    outside = "" if top == float("inf") else f"when {column} > {top} then null "
    return f"case {outside}{' '.join(arms)} end"


SUCCESS = ([0, 0.3, 0.6, 0.8, 1.0], ["Low", "Medium", "High", "Very High"])
BUDGET = ([0, 100, 500, 1000, float("inf")], ["Low", "Medium", "High", "Premium"])
ROI = ([0, 50, 100, 200, float("inf")], ["Low", "Medium", "High", "Premium"])
STAGE = ([0, 0.5, 0.7, 0.9, 1.0], ["Low", "Medium", "High", "Very High"])
CONVERSION = ([0, 0.2, 0.4, 0.6, 0.8, 1.0], ["Very Low", "Low", "Medium", "High", "Very High"])
STAGE_COARSE = ([0, 0.5, 0.8, 1.0], ["Low", "Medium", "High"])
PROBABILITY_COARSE = ([0, 0.3, 0.7, 1.0], ["Low", "Medium", "High"])

CTES: dict[str, str] = {name: oracle_text(name) for name in VIEWS}

# ---- cleaned tables
CTES.update(
    {
        "cust_ok": f"""select * from customers where customer_id is not null and strpos(email, '@') > 0
            and registration_date <= {AS_OF}""",
        "demo_ok": """select d.* from customer_demographics d
            where d.age_group is not null and exists (select 1 from cust_ok c where c.customer_id = d.customer_id)""",
        "txn_ok": f"""select t.* from transactions t
            where t.transaction_id is not null and t.total_amount > 0 and t.order_date <= {AS_OF}
              and exists (select 1 from cust_ok c where c.customer_id = t.customer_id)""",
        "item_ok": """select i.* from transaction_items i
            where i.item_id is not null and least(i.quantity, i.unit_price, i.total_price) > 0
              and i.transaction_id in (select transaction_id from txn_ok)""",
        "camp_ok": """select * from campaigns
            where campaign_id is not null and campaign_name is not null and end_date >= start_date and budget > 0""",
        "perf_ok": """select p.* from campaign_performance p
            where p.performance_id is not null and p.date is not null
              and least(p.impressions, p.clicks, p.conversions, p.revenue) >= 0
              and p.campaign_id in (select campaign_id from camp_ok)""",
        "test_ok": """select t.* from ab_tests t
            where t.test_id is not null and t.test_name is not null and t.end_date >= t.start_date
              and t.sample_size > 0 and t.campaign_id in (select campaign_id from camp_ok)""",
        "result_ok": """select r.* from ab_test_results r
            where r.result_id is not null and (r.variant = 'A' or r.variant = 'B')
              and least(r.impressions, r.clicks, r.conversions, r.revenue) >= 0
              and r.test_id in (select test_id from test_ok)""",
        "sold": "select * from txn_ok where order_status = 'Delivered' or order_status = 'Shipped'",
    }
)

# ---- customer value
CTES.update(
    {
        "rfm_base": f"""
            select c.customer_id, c.email, c.first_name, c.last_name, c.registration_date,
                   date_sub('day', o.last_order, {AS_OF}) as recency_days,
                   o.frequency, o.monetary_value,
                   cast(o.monetary_value as double) / o.n as avg_order_value,
                   coalesce(b.total_items_purchased, 0) as total_items_purchased,
                   o.unique_purchase_days,
                   cast(o.monetary_value * 1.25 as double) as customer_lifetime_value,
                   {ratio0('o.frequency', f"date_sub('month', c.registration_date, {AS_OF})")} as purchase_frequency_rate
            from cust_ok c
            join (select customer_id, max(order_date) as last_order, count(distinct transaction_id) as frequency,
                         sum(total_amount) as monetary_value, count(*) as n,
                         count(distinct order_date) as unique_purchase_days
                  from sold group by customer_id) o using (customer_id)
            left join (select s.customer_id, count(distinct i.item_id) as total_items_purchased
                       from sold s join item_ok i using (transaction_id) group by s.customer_id) b using (customer_id)""",
        "rfm_fan": f"""
            select c.customer_id, any_value(c.email) as email, any_value(c.first_name) as first_name,
                   any_value(c.last_name) as last_name, any_value(c.registration_date) as registration_date,
                   date_sub('day', max(t.order_date), {AS_OF}) as recency_days,
                   count(distinct t.transaction_id) as frequency,
                   sum(t.total_amount) as monetary_value,
                   cast(sum(t.total_amount) as double) / count(*) as avg_order_value,
                   count(distinct i.item_id) as total_items_purchased,
                   count(distinct t.order_date) as unique_purchase_days,
                   cast(sum(t.total_amount) * 1.25 as double) as customer_lifetime_value,
                   {ratio0('count(distinct t.transaction_id)', f"date_sub('month', any_value(c.registration_date), {AS_OF})")}
                     as purchase_frequency_rate
            from cust_ok c join sold t using (customer_id) left join item_ok i using (transaction_id)
            group by c.customer_id""",
        "rfm_scored": """
            select *,
                   1 + (recency_days <= 180)::int + (recency_days <= 90)::int + (recency_days <= 60)::int
                     + (recency_days <= 30)::int as recency_score,
                   1 + (frequency >= 2)::int + (frequency >= 4)::int + (frequency >= 7)::int
                     + (frequency >= 10)::int as frequency_score,
                   1 + (monetary_value >= 500)::int + (monetary_value >= 1500)::int + (monetary_value >= 3000)::int
                     + (monetary_value >= 5000)::int as monetary_score
            from rfm_base""",
        "rfm": """
            select *, 100 * recency_score + 10 * frequency_score + monetary_score as rfm_score,
                   ['New', 'Can''t Lose', 'At Risk', 'Loyal', 'Champions'][recency_score] as rfm_segment,
                   case when monetary_value < 500 then 'Minimal' when monetary_value < 1000 then 'Low'
                        when monetary_value < 2000 then 'Medium' when monetary_value < 5000 then 'High'
                        else 'Premium' end as customer_value_tier,
                   case when recency_days <= 60 and frequency >= 8 then 'Highly Engaged'
                        when recency_days <= 90 and frequency >= 5 then 'Engaged'
                        when recency_days <= 180 and frequency >= 3 then 'Moderately Engaged'
                        when recency_days <= 365 and frequency >= 1 then 'Low Engagement'
                        else 'Inactive' end as engagement_level
            from rfm_scored""",
        "rfm_sum": f"""
            select rfm_segment, customer_value_tier, engagement_level, count(*) as customer_count,
                   {half_up('monetary_value')} as avg_monetary_value,
                   round(cast(sum(frequency) as double) / count(*), 2) as avg_frequency,
                   round(cast(sum(recency_days) as double) / count(*), 1) as avg_recency_days,
                   {half_up('monetary_value * 1.25')} as avg_lifetime_value,
                   round(avg(avg_order_value), 2) as avg_order_value,
                   round(avg(purchase_frequency_rate), 2) as avg_purchase_frequency
            from rfm group by all""",
        "rfm_show": """
            select rfm_segment, customer_count, round(avg_monetary_value, 2) as avg_value,
                   round(avg_frequency, 2) as avg_orders, round(avg_recency_days, 1) as avg_days_since_purchase
            from rfm_sum""",
    }
)

# ---- campaigns
CTES.update(
    {
        "camp_tot": f"""
            select c.campaign_id, c.campaign_name, c.campaign_type, c.channel, c.target_audience, c.start_date,
                   c.end_date, c.budget, c.status,
                   sum(p.impressions) as total_impressions, sum(p.clicks) as total_clicks,
                   sum(p.conversions) as total_conversions, sum(p.revenue) as total_revenue,
                   date_sub('day', c.start_date, c.end_date) as campaign_duration
            from camp_ok c left join perf_ok p using (campaign_id)
            group by all""",
        "camp_met": f"""
            select *, {ratio0('total_clicks', 'total_impressions')} as overall_ctr,
                   {ratio0('total_conversions', 'total_clicks')} as overall_conversion_rate,
                   cast(total_revenue as double) / cast(budget as double) as overall_roas,
                   {ratio0('total_impressions', 'campaign_duration')} as avg_daily_impressions,
                   {ratio0('total_clicks', 'campaign_duration')} as avg_daily_clicks,
                   {ratio0('total_conversions', 'campaign_duration')} as avg_daily_conversions,
                   {ratio0('total_revenue', 'campaign_duration')} as avg_daily_revenue
            from camp_tot""",
        "camp": """
            select *,
                   case when overall_roas >= 1 and overall_roas < 2 then 'Low'
                        when overall_roas >= 2 and overall_roas < 3 then 'Medium'
                        when overall_roas >= 3 then 'High' else 'Poor' end as performance_segment,
                   case when coalesce(overall_roas, 0) < 1 then 0 when overall_roas < 1.5 then 20
                        when overall_roas < 2 then 40 when overall_roas < 3 then 60
                        when overall_roas < 5 then 80 else 100 end as efficiency_score,
                   cast(total_revenue as double) / cast(budget as double) * 100 as budget_utilization_percent
            from camp_met""",
        "camp_rank": """
            select *, row_number() over (order by total_revenue desc nulls last, campaign_id) as revenue_rank,
                   row_number() over (order by total_conversions desc nulls last, campaign_id) as conversion_rank,
                   row_number() over (order by overall_roas desc nulls last, campaign_id) as roas_rank
            from camp""",
        "chan_sum": f"""
            select channel, count(*) as total_campaigns, sum(budget) as total_budget, sum(total_revenue) as total_revenue,
                   avg(overall_roas) as avg_roas, avg(overall_ctr) as avg_ctr,
                   avg(overall_conversion_rate) as avg_conversion_rate,
                   sum(total_impressions) as total_impressions, sum(total_clicks) as total_clicks,
                   sum(total_conversions) as total_conversions,
                   {ratio0('sum(total_revenue)', 'sum(budget)')} as channel_roas,
                   {ratio0('sum(total_clicks)', 'sum(total_impressions)')} as channel_ctr,
                   {ratio0('sum(total_conversions)', 'sum(total_clicks)')} as channel_conversion_rate
            from camp group by channel""",
        "type_sum": f"""
            select campaign_type, count(*) as total_campaigns, sum(budget) as total_budget,
                   sum(total_revenue) as total_revenue, avg(overall_roas) as avg_roas, avg(overall_ctr) as avg_ctr,
                   avg(overall_conversion_rate) as avg_conversion_rate,
                   {ratio0('sum(total_revenue)', 'sum(budget)')} as type_roas
            from camp group by campaign_type""",
        "camp_show": """
            select 'Channel Performance' as summary_type, channel as category, total_campaigns, total_budget,
                   total_revenue, round(channel_roas, 2) as roas, round(channel_ctr * 100, 2) as ctr_percent,
                   round(channel_conversion_rate * 100, 2) as conversion_percent from chan_sum
            union all
            select 'Campaign Type Performance', campaign_type, total_campaigns, total_budget, total_revenue,
                   round(type_roas, 2), round(avg_ctr * 100, 2), round(avg_conversion_rate * 100, 2) from type_sum""",
    }
)

# ---- clickstream
CTES.update(
    {
        "ses": """
            select customer_id, count(distinct session_id) as total_sessions,
                   cast(sum(duration_seconds) as double) / count(duration_seconds) as avg_session_duration,
                   sum(duration_seconds) as total_session_time,
                   count(distinct device_type) as device_types_used, count(distinct browser) as browsers_used,
                   case sign(count(*) filter (device_type = 'Mobile') - count(*) filter (device_type = 'Desktop'))
                        when 1 then 'Mobile' when -1 then 'Desktop' else 'Mixed' end as device_preference,
                   case when count(*) filter (browser = 'Chrome') * 2 > count(browser) then 'Chrome'
                        when count(*) filter (browser = 'Safari') * 2 > count(browser) then 'Safari'
                        when count(*) filter (browser = 'Firefox') * 2 > count(browser) then 'Firefox'
                        else 'Other' end as browser_preference
            from sessions where customer_id is not null group by customer_id""",
        "pvs": """
            select customer_id, count(distinct view_id) as total_page_views, count(distinct page_url) as unique_pages_viewed,
                   cast(sum(time_on_page) as double) / count(time_on_page) as avg_time_on_page,
                   sum(time_on_page) as total_time_on_pages,
                   case when avg(scroll_depth) < 50 then 'Low' when avg(scroll_depth) < 80 then 'Medium'
                        else 'High' end as scroll_engagement
            from page_views where session_id is not null group by customer_id""",
        "evs": """
            select customer_id, count(distinct event_id) as total_events,
                   count(*) filter (event_type = 'click') as click_events,
                   count(*) filter (event_type = 'scroll') as scroll_events,
                   count(*) filter (event_type = 'form_submit') as form_submit_events,
                   count(*) filter (event_type = 'add_to_cart') as add_to_cart_events,
                   count(*) filter (event_type = 'purchase') as purchase_events,
                   case when bool_or(event_type in ('purchase', 'add_to_cart')) then 'Converter'
                        when bool_or(event_type = 'form_submit') then 'Engaged'
                        when count(*) filter (event_type = 'click') > 5 then 'Active' else 'Passive' end as event_category
            from click_events where session_id is not null group by customer_id""",
        "ints": """
            select customer_id, count(distinct interaction_id) as total_interactions,
                   count(distinct product_id) as unique_products_viewed,
                   count(*) filter (interaction_type = 'view') as product_views,
                   count(*) filter (interaction_type = 'add_to_cart') as cart_adds,
                   count(*) filter (interaction_type = 'wishlist') as wishlist_adds,
                   case when count(distinct product_id) < 5 then 'Low' when count(distinct product_id) < 10 then 'Medium'
                        else 'High' end as interaction_intensity
            from product_interactions where session_id is not null group by customer_id""",
        "srch": """
            select customer_id, count(distinct query_id) as total_search_queries,
                   count(distinct search_term) as unique_search_terms,
                   count(clicked_result_position) as clicked_search_results,
                   case when count(clicked_result_position) = 0 then 'Ineffective'
                        when count(clicked_result_position) > 0.5 * count(distinct query_id) then 'Effective'
                        else 'Moderate' end as search_effectiveness
            from search_queries where session_id is not null group by customer_id""",
        "jrn_base": """
            select c.customer_id, c.email, c.first_name, c.last_name,
                   ifnull(total_sessions, 0) as total_sessions, ifnull(avg_session_duration, 0) as avg_session_duration,
                   ifnull(device_preference, 'Unknown') as device_preference,
                   ifnull(browser_preference, 'Unknown') as browser_preference,
                   ifnull(total_page_views, 0) as total_page_views, ifnull(unique_pages_viewed, 0) as unique_pages_viewed,
                   ifnull(avg_time_on_page, 0) as avg_time_on_page,
                   ifnull(scroll_engagement, 'Unknown') as scroll_engagement,
                   ifnull(total_events, 0) as total_events, ifnull(click_events, 0) as click_events,
                   ifnull(add_to_cart_events, 0) as add_to_cart_events, ifnull(purchase_events, 0) as purchase_events,
                   ifnull(event_category, 'Unknown') as event_category,
                   ifnull(total_interactions, 0) as total_interactions,
                   ifnull(unique_products_viewed, 0) as unique_products_viewed,
                   ifnull(product_views, 0) as product_views, ifnull(cart_adds, 0) as cart_adds,
                   ifnull(interaction_intensity, 'Unknown') as interaction_intensity,
                   ifnull(total_search_queries, 0) as total_search_queries,
                   ifnull(unique_search_terms, 0) as unique_search_terms,
                   ifnull(clicked_search_results, 0) as clicked_search_results,
                   ifnull(search_effectiveness, 'Unknown') as search_effectiveness
            from cust_ok c left join ses using (customer_id) left join pvs using (customer_id)
                 left join evs using (customer_id) left join ints using (customer_id) left join srch using (customer_id)""",
        "jrn": """
            select *,
                   case when purchase_events > 0 then 'Converter' when add_to_cart_events > 0 then 'Engaged'
                        when total_sessions > 5 then 'Explorer' when total_sessions > 1 then 'Browser'
                        else 'Visitor' end as journey_type,
                   case when purchase_events > 0 then 'Converted' when add_to_cart_events > 0 then 'Abandoned'
                        else 'Browsing' end as conversion_status,
                   case when total_sessions > 10 and unique_pages_viewed > 20 then 'Complex'
                        when total_sessions > 5 and unique_pages_viewed > 10 then 'Medium'
                        else 'Simple' end as journey_complexity,
                   case when purchase_events > 0 then 100 when add_to_cart_events > 0 then 80
                        when click_events > 10 then 60 when total_sessions > 5 then 40
                        when total_sessions > 1 then 20 else 0 end as engagement_score,
                   cast(case when purchase_events > 0 then 1.0 when add_to_cart_events > 0 then 0.7
                        when click_events > 10 then 0.5 when total_sessions > 5 then 0.3
                        when total_sessions > 1 then 0.1 else 0 end as double) as conversion_probability
            from jrn_base""",
        "jrn_sum": """
            select journey_type, conversion_status, journey_complexity, device_preference, browser_preference,
                   count(*) as session_count,
                   round(avg(engagement_score), 2) as avg_engagement_score,
                   round(avg(conversion_probability), 3) as avg_conversion_probability,
                   round(avg(total_sessions), 2) as avg_sessions, round(avg(total_page_views), 2) as avg_page_views,
                   round(avg(avg_session_duration), 2) as avg_session_duration,
                   round(avg(unique_products_viewed), 2) as avg_products_viewed,
                   round(avg(total_search_queries), 2) as avg_search_queries,
                   cast(count(*) filter (purchase_events > 0) as double) / count(*) as conversion_rate,
                   cast(count(*) filter (add_to_cart_events > 0) as double) / count(*) as cart_add_rate
            from jrn group by 1, 2, 3, 4, 5""",
        "jrn_show": """
            select journey_type, conversion_status, session_count, round(avg_engagement_score, 1) as avg_engagement,
                   round(conversion_rate * 100, 2) as conversion_rate_percent,
                   round(cart_add_rate * 100, 2) as cart_add_rate_percent
            from jrn_sum""",
    }
)

# ---- A/B tests
_V = [f"variant_{v}_{m}" for v in "ab" for m in ("impressions", "clicks", "conversions", "revenue")]
CTES.update(
    {
        "ab_tot": f"""
            select t.test_id, t.test_name, t.campaign_id, t.variant_a_description, t.variant_b_description,
                   t.start_date, t.end_date, t.sample_size, t.test_status,
                   {', '.join(
                       f"coalesce(sum(r.{m}) filter (r.variant = '{v.upper()}'), 0) as variant_{v}_{m}"
                       for v in 'ab' for m in ('impressions', 'clicks', 'conversions', 'revenue'))},
                   sum(r.impressions) as total_impressions, sum(r.clicks) as total_clicks,
                   sum(r.conversions) as total_conversions, sum(r.revenue) as total_revenue
            from test_ok t left join result_ok r on r.test_id = t.test_id group by all""",
        "ab_rate": f"""
            select *, date_sub('day', start_date, end_date) as test_duration_days,
                   {', '.join(
                       ratio0(f'variant_{v}_{n}', f'variant_{v}_{d}') + f' as variant_{v}_{r}'
                       for v in 'ab'
                       for r, n, d in (('ctr', 'clicks', 'impressions'), ('conversion_rate', 'conversions', 'clicks'),
                                       ('revenue_per_impression', 'revenue', 'impressions')))}
            from ab_tot""",
        "ab_lab": """
            select *,
                   case when variant_a_ctr > 0 then (variant_b_ctr - variant_a_ctr) / variant_a_ctr * 100
                        else 0 end as ctr_lift_percentage,
                   case when variant_a_conversion_rate > 0
                        then (variant_b_conversion_rate - variant_a_conversion_rate) / variant_a_conversion_rate * 100
                        else 0 end as conversion_lift_percentage,
                   case when variant_a_revenue_per_impression > 0
                        then (variant_b_revenue_per_impression - variant_a_revenue_per_impression)
                             / variant_a_revenue_per_impression * 100 else 0 end as revenue_lift_percentage,
                   case when least(variant_a_impressions, variant_b_impressions) < 500 then 'No'
                        when least(variant_a_impressions, variant_b_impressions) < 1000 then 'Maybe'
                        else 'Yes' end as statistical_significance,
                   case when least(variant_a_impressions, variant_b_impressions) < 500 then 'Low'
                        when least(variant_a_impressions, variant_b_impressions) < 1000 then '90%'
                        when least(variant_a_impressions, variant_b_impressions) < 2000 then '95%'
                        else '99%' end as confidence_level,
                   case when least(variant_a_impressions, variant_b_impressions) < 500 then 0.50
                        when least(variant_a_impressions, variant_b_impressions) < 1000 then 0.10
                        when least(variant_a_impressions, variant_b_impressions) < 2000 then 0.05
                        else 0.01 end as p_value,
                   sign(variant_b_ctr - variant_a_ctr) as ctr_sign,
                   sign(variant_b_conversion_rate - variant_a_conversion_rate) as conversion_sign,
                   sign(variant_b_revenue_per_impression - variant_a_revenue_per_impression) as revenue_sign,
                   case when variant_a_impressions + variant_b_impressions > 2000
                        then variant_a_impressions + variant_b_impressions else 2000 end as sample_size_required
            from ab_rate""",
        "ab_win": """
            select *, case when ctr_sign = conversion_sign and ctr_sign <> 0
                           then case when ctr_sign = 1 then 'B' else 'A' end
                           when revenue_sign = 1 then 'B' when revenue_sign = -1 then 'A' else 'Tie' end as winner
            from ab_lab""",
        "ab": """
            select *, case when statistical_significance = 'Yes' and winner in ('A', 'B') then 'Implement Variant ' || winner
                           when statistical_significance = 'No' then 'Continue Testing'
                           else 'Inconclusive - Continue A' end as recommendation
            from ab_win""",
        "ab_sum": """
            select test_status, statistical_significance, winner, confidence_level, count(*) as test_count,
                   round(avg(ctr_lift_percentage), 2) as avg_ctr_lift,
                   round(avg(conversion_lift_percentage), 2) as avg_conversion_lift,
                   round(avg(revenue_lift_percentage), 2) as avg_revenue_lift,
                   round(avg(test_duration_days), 1) as avg_test_duration,
                   round(avg(sample_size_required), 0) as avg_sample_size_required,
                   avg((statistical_significance = 'Yes')::int) as significant_test_rate,
                   avg((winner <> 'Tie')::int) as clear_winner_rate,
                   avg((recommendation like 'Implement%')::int) as actionable_test_rate,
                   avg((recommendation = 'Implement Variant B')::int) as variant_b_win_rate
            from ab group by 1, 2, 3, 4""",
        "ab_show": """
            select test_status, statistical_significance, winner, test_count,
                   round(avg_ctr_lift, 1) as avg_ctr_lift_percent,
                   round(avg_conversion_lift, 1) as avg_conversion_lift_percent,
                   round(significant_test_rate * 100, 1) as significant_test_rate_percent,
                   round(clear_winner_rate * 100, 1) as clear_winner_rate_percent
            from ab_sum""",
    }
)

# ---- one row per customer
CTES.update(
    {
        "aud": """
            select target_audience, count(campaign_id) as campaign_count, avg(overall_roas) as avg_roas,
                   avg(overall_ctr) as avg_ctr, avg(overall_conversion_rate) as avg_conversion_rate,
                   coalesce(sum(total_revenue), 0) as total_campaign_revenue
            from camp where target_audience is not null group by 1""",
        "ab_type": """
            select c.campaign_type, avg(a.ctr_lift_percentage) as avg_ctr_lift,
                   avg(a.conversion_lift_percentage) as avg_conversion_lift,
                   count(*) filter (a.statistical_significance = 'Yes') as significant_ab_tests
            from ab a join camp c on a.campaign_id = c.campaign_id where c.campaign_type is not null group by 1""",
        "ab_camp": """
            select campaign_id, count(test_id) as ab_test_count, avg(ctr_lift_percentage) as avg_ctr_lift,
                   avg(conversion_lift_percentage) as avg_conversion_lift,
                   count(*) filter (statistical_significance = 'Yes') as significant_tests
            from ab group by 1""",
        "seg_map": """
            select * from (values ('Champions', 'High Value', 'Email'), ('Loyal', 'Existing Customers', 'Social Media'),
                ('At Risk', 'At Risk', 'Display'), ('Can''t Lose', 'High Value', 'Email'),
                ('New', 'New Customers', 'Search'), ('Promising', 'New Customers', 'Social Media'))
                as m(segment, audience, ctype)""",
        "joined": """
            select r.*, d.age_group, d.education_level, d.household_size, d.interests, d.lifestyle_segment,
                   j.* exclude (customer_id, email, first_name, last_name),
                   j.email as email_journey, j.first_name as first_name_journey, j.last_name as last_name_journey,
                   m.audience as target_audience, m.ctype as campaign_type,
                   a.campaign_count, a.avg_roas, a.avg_ctr, a.avg_conversion_rate, a.total_campaign_revenue,
                   x.avg_ctr_lift, x.avg_conversion_lift, x.significant_ab_tests
            from rfm r left join demo_ok d on d.customer_id = r.customer_id
                 left join jrn j on j.customer_id = r.customer_id
                 left join seg_map m on m.segment = r.rfm_segment
                 left join aud a on a.target_audience = m.audience
                 left join ab_type x on x.campaign_type = m.ctype""",
        "uni": f"""
            select * replace (ifnull(age_group, 'Unknown') as age_group,
                       ifnull(education_level, 'Unknown') as education_level,
                       ifnull(interests, 'Unknown') as interests,
                       ifnull(lifestyle_segment, 'Unknown') as lifestyle_segment,
                       ifnull(household_size, 0) as household_size,
                       ifnull(campaign_count, 0) as campaign_count, ifnull(avg_roas, 0) as avg_roas,
                       ifnull(avg_ctr, 0) as avg_ctr, ifnull(avg_conversion_rate, 0) as avg_conversion_rate,
                       ifnull(total_campaign_revenue, 0) as total_campaign_revenue,
                       ifnull(avg_ctr_lift, 0) as avg_ctr_lift, ifnull(avg_conversion_lift, 0) as avg_conversion_lift,
                       ifnull(significant_ab_tests, 0) as significant_ab_tests),
                   {AS_OF} - registration_date as customer_age_days,
                   recency_days as days_since_last_purchase,
                   engagement_score / 100 as engagement_score_normalized,
                   frequency / ({AS_OF} - registration_date + 1) as purchase_velocity,
                   total_page_views / (total_sessions + 1) as session_intensity,
                   purchase_events / (total_sessions + 1) as conversion_efficiency,
                   total_search_queries / (total_sessions + 1) as search_intensity,
                   unique_products_viewed / (total_sessions + 1) as product_exploration,
                   cart_adds / (total_sessions + 1) as cart_behavior,
                   (recency_score + frequency_score + monetary_score) / 3 as rfm_composite,
                   cast(monetary_value as double) / (engagement_score + 1) as value_engagement_ratio,
                   ifnull(avg_ctr * avg_conversion_rate, 0) as campaign_response_rate,
                   ifnull(avg_ctr_lift * avg_conversion_lift, 0) as ab_test_impact,
                   1 / (recency_days + 1) as churn_risk,
                   cast(monetary_value as double) * (frequency / ({AS_OF} - registration_date + 1)) as upsell_potential,
                   customer_lifetime_value * (engagement_score / 100) as lifetime_value_potential,
                   (customer_value_tier = 'Premium')::int as is_high_value,
                   (engagement_level in ('Highly Engaged', 'Engaged'))::int as is_engaged,
                   (device_preference = 'Mobile')::int as is_mobile_user,
                   (total_sessions > 1)::int as is_return_visitor,
                   {AS_OF} as dataset_created_at, '1.0' as data_version
            from joined""",
        "hist": f"""
            select customer_id, count(*) as total_orders, {AS_OF} - min(order_date) as days_since_first_order,
                   case when count(*) > 1 then (max(order_date) - min(order_date)) / (count(*) - 1) end
                     as avg_days_between_orders,
                   {', '.join(
                       f"count(*) filter (order_date >= {AS_OF} - {n}) as order_count_{n}d, "
                       f"cast(coalesce(sum(total_amount) filter (order_date >= {AS_OF} - {n}), 0) as double) as revenue_{n}d"
                       for n in (30, 90, 365))}
            from sold group by customer_id""",
        "daily": """
            select customer_id, order_date as order_day, cast(sum(total_amount) as double) as revenue, count(*) as orders
            from sold group by 1, 2""",
        "lags": f"""
            select d.customer_id, d.order_day, d.revenue,
                   {', '.join(f'coalesce(sum(p.revenue) filter (p.order_day = d.order_day - {n}), 0) as revenue_lag_{n}' for n in (1, 7, 30))},
                   {', '.join(f'sum(p.revenue) filter (p.order_day > d.order_day - {n}) / {n} as revenue_ma_{n}' for n in (7, 30))}
            from daily d join daily p on p.customer_id = d.customer_id
                 and p.order_day between d.order_day - 30 and d.order_day
            group by 1, 2, 3""",
    }
)

# ---- score tables by formula
CTES.update(
    {
        "clus": "select *, case when recency_days > 1500 then -1 else frequency_score end as cluster from uni",
        "sc_rev": """select customer_id, cast(monetary_value as double) * 0.9 + recency_days * 0.1 as predicted_revenue,
                            cast(monetary_value as double) as actual_revenue from uni""",
        "sc_stage0": """select customer_id, journey_type as predicted_journey_stage,
                            (recency_days % 61 + 40) / 100.0 as stage_confidence from uni""",
        "sc_stage": f"select *, {bins('stage_confidence', *STAGE)} as stage_category from sc_stage0",
        "sc_conv0": """select customer_id, (recency_days % 101) / 100.0 as predicted_conversion_probability,
                            0.85 as conversion_confidence from uni""",
        "sc_conv": f"""select *, {bins('predicted_conversion_probability', *CONVERSION)} as conversion_category,
                            predicted_conversion_probability * 100 as expected_value from sc_conv0""",
        "sc_succ0": """select customer_id, case when rfm_score < 200 then 'low' when rfm_score < 400 then 'medium'
                              else 'high' end as predicted_campaign_success,
                            (recency_days % 101) / 100.0 as success_probability,
                            greatest((recency_days % 101) / 100.0, 1 - (recency_days % 101) / 100.0) as success_confidence
                     from uni""",
        "sc_succ": f"select *, {bins('success_probability', *SUCCESS)} as success_category from sc_succ0",
        "sc_bud": f"""select customer_id, recency_days * 2.5::double as predicted_optimal_budget, 0.85 as budget_confidence,
                            {bins('recency_days * 2.5::double', *BUDGET)} as budget_category,
                            recency_days * 2.5::double * 0.15::double as estimated_roi from uni""",
        "seg_stat": """select cluster, round(avg(monetary_value), 2) as monetary_value_mean,
                            count(*) as monetary_value_count, round(avg(frequency), 2) as frequency_mean
                     from clus group by 1""",
        "demo_seg": """select customer_id, cluster, 'Segment_' || cast(cluster as varchar) as demo_segment_type,
                            monetary_value_mean as demo_avg_monetary, frequency_mean as demo_avg_frequency,
                            monetary_value_count as demo_segment_size
                     from clus join seg_stat using (cluster)""",
    }
)


def _needed(text: str) -> list[str]:
    """Names of the relations a text reads, dependencies first."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(?:from|join)\s+{name}\b", body):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(text)
    return order


# ---- oracles by query name -----------------------------------------------------------

_RFM_I = "recency_days frequency total_items_purchased unique_purchase_days"
_RFM_F = "monetary_value avg_order_value customer_lifetime_value purchase_frequency_rate"
_RFM_S = "customer_id email first_name last_name registration_date"
_RFM_SCORES = "recency_score frequency_score monetary_score rfm_score"
_RFM_LABELS = "rfm_segment customer_value_tier engagement_level"
_CUST = dict(
    s="customer_id email first_name last_name date_of_birth gender country income_bracket registration_date", b="is_active"
)
_DEMO = dict(s="customer_id age_group education_level interests lifestyle_segment", i="household_size")
_TXN = dict(
    s="transaction_id customer_id order_date currency payment_method order_status", f="total_amount"
)
_ITEM = dict(
    s="item_id transaction_id product_id product_name category subcategory", i="quantity", f="total_price unit_price"
)
_CAMP_S = "campaign_id campaign_name campaign_type channel target_audience start_date end_date status"
_CAMP = dict(s=_CAMP_S, f="budget")
_CAMP_I = "total_impressions total_clicks total_conversions campaign_duration"
_CAMP_F = (
    "budget total_revenue overall_ctr overall_conversion_rate overall_roas avg_daily_impressions avg_daily_clicks "
    "avg_daily_conversions avg_daily_revenue"
)
_TEST_S = "test_id test_name campaign_id variant_a_description variant_b_description start_date end_date test_status"
_JRN_S = (
    "customer_id email first_name last_name device_preference browser_preference scroll_engagement event_category "
    "interaction_intensity search_effectiveness journey_type conversion_status journey_complexity"
)
_JRN_I = (
    "total_sessions total_page_views unique_pages_viewed total_events click_events add_to_cart_events "
    "purchase_events total_interactions unique_products_viewed product_views cart_adds total_search_queries "
    "unique_search_terms clicked_search_results engagement_score"
)
_JRN_F = "avg_session_duration avg_time_on_page conversion_probability"
_RATES = " ".join(f"variant_{v}_{r}" for v in "ab" for r in ("ctr", "conversion_rate", "revenue_per_impression"))
_JSUM = dict(
    s="journey_type conversion_status journey_complexity device_preference browser_preference",
    i="session_count",
    f="avg_engagement_score avg_conversion_probability avg_sessions avg_page_views avg_session_duration "
    "avg_products_viewed avg_search_queries conversion_rate cart_add_rate",
)
_SHOW_CAMP = dict(
    s="summary_type category", i="total_campaigns",
    f="total_budget total_revenue roas ctr_percent conversion_percent",
)
_DQ = """select 'customers' as table_name, (select count(*) from cust_ok) as clean_count,
                (select count(*) from customers) as original_count
         union all select 'transactions', (select count(*) from txn_ok), (select count(*) from transactions)
         union all select 'campaigns', (select count(*) from camp_ok), (select count(*) from campaigns)
         union all select 'ab_tests', (select count(*) from test_ok), (select count(*) from ab_tests)"""
_LAGS = dict(
    s="customer_id", f="revenue revenue_lag_1 revenue_lag_7 revenue_lag_30 revenue_ma_7 revenue_ma_30"
)
_MASTER = """
    select family, model, count(*) as models_run, cast(sum(n) as bigint) as total_predictions
    from (select 'forecasting' as family, 'revenue' as model, (select count(*) from sc_rev) as n
          union all select 'journey_simulation', 'journey_stage', (select count(*) from sc_stage)
          union all select 'journey_simulation', 'conversion_prediction', (select count(*) from sc_conv)
          union all select 'campaign_optimization', 'campaign_success', (select count(*) from sc_succ))
    group by rollup (family, model)"""


def _known_lags(label_day: str) -> str:
    """What orders and clicks before the label day say; ties cannot occur, as days are summed."""
    lag = """(select cast(arg_max(r, d) as double) from spent x
              where x.customer_id = lab.customer_id and x.d <= lab.label_day - {n}) as revenue_lag_{n}"""
    mean = """coalesce((select cast(sum(r) as double) from spent x where x.customer_id = lab.customer_id
              and x.d < lab.label_day and x.d >= lab.label_day - {n}), 0) / {n} as revenue_ma_{n}"""
    rate = "case when sum(i) = 0 then 0 else sum(c) / sum(i) end"
    return f"""
        with spent as (select customer_id, cast(order_date as date) as d, sum(total_amount) as r from sold group by 1, 2),
        clicked as (select target_audience as a, cast(date as date) as d, sum(clicks) as c, sum(impressions) as i
                    from perf_ok join camp_ok using (campaign_id) group by 1, 2),
        lab as (select customer_id, target_audience, cast({label_day} as date) as label_day from uni),
        known as (select customer_id, label_day, {", ".join(lag.format(n=n) for n in (1, 7, 30))},
                         {", ".join(mean.format(n=n) for n in (7, 30))},
                         (select {rate} from clicked where a = target_audience and d = (select max(d) from clicked z
                           where z.a = lab.target_audience and z.d < lab.label_day) having count(*) > 0) as ctr_lag_1,
                         (select {rate} from clicked where a = target_audience and d < label_day and d >= label_day - 7) as ctr_now,
                         target_audience is not null as has_audience
                  from lab)
        select customer_id, cast(label_day as varchar) as label_day,
               {", ".join(f"round({c}, 6) + 0.0 as {c}" for c in ("revenue_lag_1", "revenue_lag_7", "revenue_lag_30", "revenue_ma_7", "revenue_ma_30", "ctr_lag_1"))},
               case when has_audience then round(coalesce(ctr_now, 0), 6) + 0.0 end as ctr_ma_7
        from known"""


def _hash(seed: int = 42) -> str:
    return f"(cast('0x' || substr(md5(customer_id || ':{seed}'), 1, 8) as bigint) / 4294967296.0::double)"


def _line(section: str, key: str, value: str, source: str) -> str:
    return f"select '{section}' as section, {key} as key, round(cast({value} as double), 6) + 0.0 as value from {source}"


def _lines(*parts: str) -> str:
    return " union all ".join(parts)


def _summary(section: str, source: str, **values: str) -> list[str]:
    return [_line(section, f"'{key}'", value, source) for key, value in values.items()]


def _group(section: str, column: str, source: str) -> str:
    return (
        f"select '{section}' as section, cast({column} as varchar) as key, cast(count(*) as double) as value "
        f"from {source} where {column} is not null group by {column}"
    )


def _top(section: str, source: str, column: str, mean: bool) -> list[str]:
    bound = f"(select quantile_cont(cast({column} as double), 0.8) from {source})"
    high = f"count(*) filter (cast({column} as double) >= {bound})"
    values = {"threshold": f"any_value({bound})", "customers": high, "percent": f"{high} / count(*) * 100"}
    if mean:
        values["mean"] = f"avg({column}) filter (cast({column} as double) >= {bound})"
    return _summary(section, source, **values)


def _confidence(source: str, column: str) -> list[str]:
    return [
        *_summary(
            "summary", source, total_customers="count(*)", avg_confidence=f"avg(cast({column} as double))",
            min_confidence=f"min({column})", max_confidence=f"max({column})",
        ),
        *_top("high_confidence", source, column, False),
    ]


def _forecast() -> str:
    p = "predicted_revenue"
    q = {n: f"quantile_cont({p}, {x})" for n, x in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}
    return _lines(
        *_summary(
            "summary", "sc_rev", total_customers="count(*)", avg_prediction=f"avg({p})", min_prediction=f"min({p})",
            max_prediction=f"max({p})", std_prediction=f"stddev_samp({p})", total_predicted_value=f"sum({p})",
            median_prediction=f"median({p})",
        ),
        *_summary(
            "distribution", "sc_rev", count="count(*)", mean=f"avg({p})", std=f"stddev_samp({p})", min=f"min({p})",
            max=f"max({p})", **q,
        ),
        *_top("high_value", "sc_rev", p, True),
    )


def _describe(column: str, source: str) -> str:
    v = f"cast({column} as double)"
    stats = {
        "count": f"count({v})", "mean": f"avg({v})", "std": f"stddev_samp({v})", "min": f"min({v})",
        "q25": f"quantile_cont({v}, 0.25)", "q50": f"quantile_cont({v}, 0.5)", "q75": f"quantile_cont({v}, 0.75)",
        "max": f"max({v})",
    }
    inner = ", ".join(f"round(cast({x} as double), 6) + 0.0 as {n}" for n, x in stats.items())
    return f"select '{column}' as column_name, {inner} from {source}"


def _histogram(column: str, n: int, source: str) -> str:
    v = f"cast({column} as double)"
    return f"""
        select cast(bin as bigint) as bin, round(low + bin * width, 6) + 0.0 as bin_start,
               round(low + (bin + 1) * width, 6) + 0.0 as bin_end, cast(count(*) as bigint) as count
        from (select least(floor(({v} - low) / width), {n - 1}) as bin, low, width
              from {source}, (select min({v}) as low, (max({v}) - min({v})) / {n} as width from {source}))
        group by bin, low, width"""


def _profile(segment: str) -> str:
    measures = [
        "monetary_value", "frequency", "recency_days", "engagement_score", "customer_lifetime_value", "churn_risk",
        "upsell_potential",
    ]
    inner = ", ".join(
        f"round(avg(cast({m} as double)), 2) + 0.0 as {m}_mean, round(stddev_samp(cast({m} as double)), 2) + 0.0 as {m}_std"
        for m in measures
    )
    return f"select {segment}, {inner}, count(*) as monetary_value_count from uni group by {segment}"


def _clip(column: str) -> str:
    v = f"cast({column} as double)"
    q1, q3 = (f"(select quantile_cont({v}, {x}) from rfm)" for x in (0.25, 0.75))
    return f"round(least(greatest({v}, {q1} - 1.5 * ({q3} - {q1})), {q3} + 1.5 * ({q3} - {q1})), 6) + 0.0 as {column}"


def _split(condition: str, columns: str, source: str) -> str:
    return f"select {columns}, case when {condition} then 'first' else 'second' end as part from {source}"


_SILHOUETTE = """
    select round(avg(case when a.n = 1 then 0.0 else (b.d - a.d) / greatest(a.d, b.d) end), 6) as silhouette
    from (select customer_id, cl, d * n / nullif(n - 1, 0) as d, n from dist where cl = own) a
    join (select customer_id, min(d) as d from dist where cl <> own group by 1) b using (customer_id)"""
CTES["cl_stat"] = """
    select cluster as cl, count(*) as n, sum(recency_days::double) as s0, sum(frequency::double) as s1,
           sum(recency_days::double ** 2 + frequency::double ** 2) as q
    from clus group by 1"""
CTES["dist"] = """
    select c.customer_id, c.cluster as own, s.cl, s.n,
           c.recency_days::double ** 2 + c.frequency::double ** 2 + s.q / s.n
             - 2 * (c.recency_days * s.s0 + c.frequency * s.s1) / s.n as d
    from clus c join cl_stat s on true"""
CTES["guessed"] = """
    select journey_type as y, case when total_sessions > 7 then 'Explorer' when click_events > 2 then 'Converter'
                                   else journey_type end as p
    from jrn"""
CTES["cls"] = """
    select y, count(*) as support, count(*) filter (y = p) as hits,
           (select count(*) from guessed g where g.p = o.y) as predicted
    from guessed o group by y"""
CTES["prf"] = """
    select support, hits, case when predicted > 0 then hits / predicted else 0 end as pr, hits / support as re from cls"""


_LABELLED = "select customer_id, segment from placed"
_NAMED = """select customer_id, segment as density_segment, case when segment = -1 then 'Noise'
               else 'Segment_' || cast(dense_rank() over (order by segment) - 1 as varchar) end as density_segment_type
            from placed"""


def _density(features: list[str], result: str = _LABELLED, eps: float = 0.1, size: int = 50) -> str:
    """Brute-force DBSCAN* with 10 samples."""
    axes = ", ".join(
        "coalesce(({0} - avg({0}) over ()) / nullif(stddev_samp({0}) over (), 0), 0) as x{1}".format(
            f"coalesce(cast({f} as double), 0)", i
        )
        for i, f in enumerate(features)
    )
    near = " + ".join(f"(a.x{i} - b.x{i}) ** 2" for i in range(len(features)))
    return f"""/*recursive*/,
        pts as (select customer_id as id, {axes} from uni),
        nb as materialized (select a.id as a, b.id as b from pts a join pts b on {near} <= {eps} ** 2),
        core as materialized (select a as id from nb group by a having count(*) >= 10),
        link as materialized (select a, b from nb where a in (select id from core) and b in (select id from core)),
        reach(id, root) as (select id, id from core union select l.b, r.root from reach r join link l on l.a = r.id),
        lab as (select id, min(root) as root from reach group by id),
        big as (select root, row_number() over (order by root) - 1 as segment
                from lab group by root having count(*) >= {size}),
        placed as (select pts.id as customer_id, cast(coalesce(big.segment, -1) as bigint) as segment
                   from pts left join lab on lab.id = pts.id left join big on big.root = lab.root)
        {result}"""


_HASH_42 = "(cast('0x' || substr(md5(customer_id || ':42'), 1, 8) as bigint) / 4294967296.0::double)"


def _scaled(features: list[str]) -> str:
    """Distinct standardised positions ``pos`` with their copies, and the distance of each point to
    its tenth other one, ``core``."""
    axes = ", ".join(
        "coalesce(({0} - avg({0}) over ()) / nullif(stddev_samp({0}) over (), 0), 0) as x{1}".format(
            f"coalesce(cast({f} as double), 0)", i
        )
        for i, f in enumerate(features)
    )
    names = ", ".join(f"x{i}" for i in range(len(features)))
    away = " + ".join(f"(a.x{i} - b.x{i}) ** 2" for i in range(len(features)))
    return f"""/*recursive*/,
        pts as (select customer_id as id, {axes} from uni),
        pos as (select min(id) as id, {names} from pts group by {names}),
        near as (select a.id, sqrt({away}) as away, row_number() over (partition by a.id order by {away}) as place
                 from pts a join pts b on true),
        core as (select id, away as core from near where place = 11)"""


def _tree_components(features: list[str], limits: str) -> str:
    away = " + ".join(f"(a.x{i} - b.x{i}) ** 2" for i in range(len(features)))
    return f"""{_scaled(features)},
        limits as (select unnest([{limits}]::double[]) as within),
        dense as materialized (select within, pos.*, core from pos join core using (id) join limits on core <= within),
        link as materialized (select a.within, a.id as a, b.id as b from dense a join dense b
                 on a.within = b.within and sqrt({away}) <= a.within),
        reach(within, id, root) as (select within, id, id from dense
            union select l.within, l.b, r.root from reach r join link l on l.a = r.id and l.within = r.within where l.b > r.root),
        low as (select within, id, min(root) as root from reach group by all)
        select within, count(distinct id) as core_positions, count(distinct root) as components from limits left join low using (within)
        group by within"""


_RECENT = f"uni where registration_date >= {AS_OF} - 90"
_KMEANS = "silhouette_score calinski_harabasz_score training_cost n_clusters"
_CLASSIFIER = "accuracy precision recall f1 n_estimators max_depth"
_REGRESSOR = "mae mse rmse r2 n_estimators max_depth"


_SETTINGS = {"n_estimators": "100", "max_depth": "10", "n_clusters": "5"}
_OLD_ROWS = f"tr as (select * from uni where registration_date < {AS_OF} - 90)"
_AS_DOUBLE = "cast(monetary_value as double)"
# the labels of the models, from the training rows
_TARGETS = {
    "l6_success_classifier": """case when avg_roas > 3 and avg_ctr > 0.05 then 'high'
                                     when avg_roas > 2 and avg_ctr > 0.03 then 'medium' else 'low' end""",
    "l7_budget_regressor": "least(1000, greatest(100, cast(total_campaign_revenue as double) * avg_roas / 2))::double",
    "l8_revenue_regressor": _AS_DOUBLE,
    "l9_ctr_regressor": "avg_ctr::double",
    "l10_stage_classifier": """case when frequency >= 5 then 'loyal_customer' when frequency >= 2 then 'repeat_customer'
        when frequency = 1 then 'first_time_buyer' when cart_adds > 0 then 'cart_abandoner'
        when product_views > 0 then 'product_browser' else 'visitor' end""",
    "l11_conversion_regressor": """least(0.95, 0.1
        + case when rfm_score > 80 then 0.3 when rfm_score > 60 then 0.2 when rfm_score > 40 then 0.1 else 0 end
        + 0.1 * ((total_page_views > 10)::int + (total_events > 5)::int + (total_interactions > 3)::int
                 + (product_views > 5)::int) + 0.2 * (cart_adds > 0)::int)::double""",
    "l6_success_classifier_history": """(avg_roas > (select median(avg_roas) from tr)
        and avg_ctr > (select median(avg_ctr) from tr))::int::varchar""",
    "l7_budget_regressor_history": "(customer_lifetime_value * 0.1)::double",
    "l8_revenue_regressor_history": f"{_AS_DOUBLE} * (1 + frequency / 10)",
    "l9_ctr_regressor_history": "least(0.15, greatest(0.01, 0.05 * (1 + frequency / 10)))::double",
    "l10_stage_classifier_history": "least(4, frequency // 2)::int::varchar",
    "l11_conversion_classifier_history": f"({_AS_DOUBLE} > (select median({_AS_DOUBLE}) from tr))::int::varchar",
}


def _sound(model: str, names: str, more: str = "") -> str:
    lines = [
        f"select '{model}' as model, '{n}' as metric, true as sound, cast({_SETTINGS.get(n, 'null')} as double) as value"
        for n in names.split()
    ]
    return " union all ".join(lines) + more


def _guessed(name: str, model: str, names: str, stratify: bool = False) -> str:
    """Soundness of the metrics, and of the same split: rows, labels, and the best constant guess."""
    test = (
        f"row_number() over (partition by y order by {_HASH_42}, customer_id) > round(0.8 * count(*) over (partition by y))"
        if stratify
        else f"{_HASH_42} < 0.2::double"
    )
    values = {"n_train": "count(*) filter (not test)", "n_test": "count(*) filter (test)"}
    if "accuracy" in names:
        guess = "(select y from dealt where not test group by y order by count(*) desc, y limit 1)"
        values["baseline_accuracy"] = f"avg((y = {guess})::int) filter (test)"
    else:
        mean = "(select avg(y) from dealt where not test)"
        values["label_min"], values["label_max"] = "min(y) filter (not test)", "max(y) filter (not test)"
        values["baseline_rmse"] = f"sqrt(avg((y - {mean}) ** 2) filter (test))"
    more = "".join(
        f" union all select '{model}', '{n}', true, round(cast({v} as double), 6) + 0.0 from dealt" for n, v in values.items()
    )
    return f"""with {_OLD_ROWS}, labelled as (select customer_id, {_TARGETS[name]} as y from tr),
        dealt as (select y, {test} as test from labelled where y is not null)
        {_sound(model, names, more)}"""


def _one_cluster(names: str, features: list[str], where: str) -> str:
    """A standardised axis that varies adds n - 1 to the cost of a single cluster."""
    moving = " + ".join(f"(stddev_samp(coalesce(cast({f} as double), 0)) > 0)::int" for f in features) or "0"
    more = f" union all select 'kmeans', 'n_train', true, cast(count(*) as double) from tr where {where}"
    if features:
        more += f""" union all select 'kmeans', 'baseline_cost', true, round(cast((count(*) - 1) * ({moving}) as double), 6)
                     from tr where {where}"""
    return f"with {_OLD_ROWS} {_sound('kmeans', names, more)}"


def _folded(name: str, values: dict[str, str], target: str) -> str:
    more = "".join(
        f" union all select '{n}', true, round(cast({v} as double), 6) + 0.0 from dealt" for n, v in values.items()
    )
    return f"""with {_OLD_ROWS}, dealt as (select {_TARGETS[target]} as y from tr)
        select unnest(['{name}_mean', '{name}_std']) as metric, true as sound, cast(null as double) as value{more}"""


def _report_rows() -> str:
    """All rows of the models and of the cross-validation, with what does not depend on a fit."""
    regressor = _REGRESSOR.replace("r2 ", "")
    models = {
        "kmeans": _KMEANS, "revenue": regressor, "ctr": regressor, "journey_stage": _CLASSIFIER, "conversion": regressor,
        "campaign_success": f"{_CLASSIFIER} cv_accuracy_mean cv_accuracy_std n_rows",
        "budget": f"{regressor} cv_r2_mean cv_r2_std n_rows",
    }
    known = {"n_estimators": "100", "max_depth": "10", "n_rows": "(select count(*) from tr)"}
    lines = [
        f"select '{m}' as section, '{n}' as key, cast({known.get(n, 'null')} as double) as value"
        for m, names in models.items() for n in names.split()
    ]
    return f"with {_OLD_ROWS} {' union all '.join(lines)}"


def _consistent(constants: str = "", source: str = _RECENT) -> str:
    return f"select customer_id, {constants}{', ' if constants else ''}true as consistent from {source}"


def _forecast_constants(confidence: float, period: str) -> str:
    return f"cast({confidence} as double) as forecast_confidence, '{period}' as forecast_period, cast({AS_OF} as varchar) as forecast_date"


ORACLES: dict[str, str] = {
    # sources and sinks
    "s1_relational_scan": pick("transactions", **_TXN),
    "s2_document_scan": pick("sessions", s="session_id customer_id device_type browser", i="duration_seconds"),
    "s3_load_rfm": pick("rfm", i=f"{_RFM_I} {_RFM_SCORES}", f=_RFM_F, s=f"{_RFM_S} {_RFM_LABELS}"),
    "s3_load_demographics": pick("demo_ok", **_DEMO),
    "s3_load_campaigns": pick(
        "camp_rank",
        s=f"{_CAMP_S} performance_segment",
        i="total_impressions total_clicks total_conversions efficiency_score revenue_rank conversion_rank roas_rank",
        f="budget total_revenue overall_ctr overall_conversion_rate overall_roas budget_utilization_percent",
    ),
    "s3_load_ab_tests": pick(
        "ab",
        s=f"{_TEST_S} winner confidence_level statistical_significance recommendation",
        i="test_duration_days sample_size_required",
        f="variant_a_ctr variant_b_ctr variant_a_conversion_rate variant_b_conversion_rate ctr_lift_percentage "
        "conversion_lift_percentage revenue_lift_percentage p_value",
    ),
    "s3_load_journey": pick("jrn", s=_JRN_S, i=_JRN_I, f=_JRN_F),
    "s4_parquet_scan": pick("orders", i="o_orderkey o_custkey", f="o_totalprice"),
    "s5_csv_round_trip": pick("demo_ok", **_DEMO),
    "s6_materialize": pick(
        "rfm_sum", s=_RFM_LABELS, i="customer_count",
        f="avg_monetary_value avg_frequency avg_recency_days avg_lifetime_value avg_order_value avg_purchase_frequency",
    ),
    "s7_parquet_round_trip": pick("txn_ok", **_TXN),
    "s8_snapshots": "select customer_id, rfm_segment, '20010802_120000' as run_ts from rfm",
    "s9_report_sink": _forecast(),
    "s10_file_manifest": _files("region nation customer supplier part orders lineitem events"),
    "s11_latest_by_suffix": """select o_orderpriority, count(*) filter (where o_orderkey % 2 = 1) as orders
        from orders group by o_orderpriority""",
    "s13_changed_files": """select event_id, round(value * 1000000) / 1000000 as value from events
        where event_type = 'click'""",
    "s14_suffix_listing": _files("orders events"),
    "s15_timeline_info": _files("region nation customer supplier part orders lineitem events"),
    "s12_recent_orders": pick(f"txn_ok where order_date >= {AS_OF} - 90", **_TXN),
    # projections, filters, predicates
    "p1_clean_customers": pick("cust_ok", **_CUST),
    "p2_clean_demographics": pick("demo_ok", **_DEMO),
    "p3_clean_transactions": pick("txn_ok", **_TXN),
    "p4_clean_items": pick("item_ok", **_ITEM),
    "p5_clean_campaigns": pick("camp_ok", **_CAMP),
    "p6_clean_campaign_performance": pick(
        "perf_ok", s="performance_id campaign_id date", i="impressions clicks conversions", f="revenue"
    ),
    "p7_clean_ab_tests": pick("test_ok", s=_TEST_S, i="sample_size"),
    "p8_clean_ab_results": pick("result_ok", s="result_id test_id variant", i="impressions clicks conversions", f="revenue"),
    "p9_successful_orders": pick("sold", **_TXN),
    "p10_session_not_null": pick(
        "page_views where session_id is not null", s="view_id session_id customer_id page_url", i="time_on_page scroll_depth"
    ),
    "p11_ladder": """select transaction_id, case when total_amount < 150 then 'small' when total_amount < 300 then 'medium'
                     else 'large' end as size from txn_ok""",
    "p12_select_available": pick("rfm", s="customer_id", i="frequency recency_days"),
    "p13_default_missing": """select customer_id, cast(frequency as bigint) as frequency, 0.0::double as campaign_count,
                              1.0::double as avg_roas, 50.0::double as engagement_score, 365.0::double as idle_days,
                              0.0::double as other from rfm""",
    "p14_with_purchases": pick("rfm where monetary_value > 0", s="customer_id", f="monetary_value"),
    "p15_drop_incomplete": pick("customer_demographics where age_group is not null", s="customer_id age_group"),
    "p16_require_rows": "select count(*) >= 100 as enough, false as too_few from cust_ok",
    "p17_stamp": f"select customer_id, cast({AS_OF} as varchar) as dataset_created_at, '1.0' as data_version from cust_ok",
    # joins
    "j1_inner_join_dimension": """select t.test_id, t.campaign_id, c.channel, c.campaign_type
                                  from test_ok t join camp_ok c on t.campaign_id = c.campaign_id""",
    "j2_keep_with_parent": """select t.transaction_id, t.customer_id
                              from transactions t join cust_ok c on t.customer_id = c.customer_id""",
    "j3_order_item_chain": pick("rfm", s="customer_id", i="frequency total_items_purchased"),
    "j4_left_join_aggregate": pick("camp_tot", s="campaign_id", i="total_clicks", f="total_revenue"),
    "j5_star_join": pick("jrn", s=_JRN_S, i=_JRN_I, f=_JRN_F),
    "j6_merge_suffix": """select r.customer_id, r.email, cast(r.frequency as bigint) as frequency, j.email as email_journey,
                          cast(j.total_sessions as bigint) as total_sessions
                          from rfm r left join jrn j on j.customer_id = r.customer_id""",
    "j7_merge_demographics": """select r.customer_id, r.rfm_segment, d.age_group, cast(d.household_size as bigint) as household_size
                                from rfm r left join demo_ok d on d.customer_id = r.customer_id""",
    "j8_map_values": """select r.customer_id, m.audience as target_audience, m.ctype as campaign_type
                        from rfm r left join seg_map m on m.segment = r.rfm_segment""",
    "j9_merge_audience": pick(
        "joined", s="customer_id target_audience", i="campaign_count", f="avg_roas total_campaign_revenue"
    ),
    "j10_tests_with_campaign_type": pick(
        "ab_type", s="campaign_type", i="significant_ab_tests", f="avg_ctr_lift avg_conversion_lift"
    ),
    "j11_anti_join": """select transaction_id, customer_id from transactions
                        where customer_id not in (select customer_id from cust_ok)""",
    "j12_attach_segment_profile": pick(
        "demo_seg", s="customer_id demo_segment_type", i="cluster demo_segment_size", f="demo_avg_monetary demo_avg_frequency"
    ),
    "j13_rule_segments": f"""
        select customer_id || '-' || segment_id as mapping_id, customer_id, segment_id,
               cast({AS_OF} as varchar) as assigned_date, 1.0::double as confidence_score
        from (select customer_id, unnest([x for x in [
                case when rfm_score = 5 and monetary_value > 1000 then 'SEG_001' end,
                case when frequency > 10 and recency_days < 30 then 'SEG_002' end,
                case when recency_days > 90 and frequency < 3 then 'SEG_003' end,
                case when registration_date > {AS_OF} - 30 and frequency < 5 then 'SEG_004' end,
                case when recency_days > 180 and not is_active then 'SEG_005' end] if x is not null]) as segment_id
              from rfm join (select customer_id, is_active from cust_ok) using (customer_id))""",
    # aggregations
    "a1_rfm_metrics": pick("rfm_base", i=_RFM_I, f=_RFM_F, s=_RFM_S),
    "a1_rfm_metrics_fanout": pick("rfm_fan", i=_RFM_I, f=_RFM_F, s=_RFM_S),
    "a2_rfm_summary": pick(
        "rfm_sum", s=_RFM_LABELS, i="customer_count",
        f="avg_monetary_value avg_frequency avg_recency_days avg_lifetime_value avg_order_value avg_purchase_frequency",
    ),
    "a3_campaign_metrics": pick("camp_met", s=_CAMP_S, i=_CAMP_I, f=_CAMP_F),
    "a4_channel_summary": pick(
        "chan_sum", s="channel", i="total_campaigns total_impressions total_clicks total_conversions",
        f="total_budget total_revenue avg_roas avg_ctr avg_conversion_rate channel_roas channel_ctr channel_conversion_rate",
    ),
    "a5_type_summary": pick(
        "type_sum", s="campaign_type", i="total_campaigns",
        f="total_budget total_revenue avg_roas avg_ctr avg_conversion_rate type_roas",
    ),
    "a6_session_stats": pick(
        "ses", s="customer_id device_preference browser_preference",
        i="total_sessions total_session_time device_types_used browsers_used", f="avg_session_duration",
    ),
    "a7_page_view_stats": pick(
        "pvs", s="customer_id scroll_engagement", i="total_page_views unique_pages_viewed total_time_on_pages",
        f="avg_time_on_page",
    ),
    "a8_event_stats": pick(
        "evs", s="customer_id event_category",
        i="total_events click_events scroll_events form_submit_events add_to_cart_events purchase_events",
    ),
    "a9_interaction_stats": pick(
        "ints", s="customer_id interaction_intensity",
        i="total_interactions unique_products_viewed product_views cart_adds wishlist_adds",
    ),
    "a10_search_stats": pick(
        "srch", s="customer_id search_effectiveness", i="total_search_queries unique_search_terms clicked_search_results"
    ),
    "a11_journey_summary": pick("jrn_sum", **_JSUM),
    "a12_ab_variant_totals": pick(
        "ab_tot", s=_TEST_S,
        i="sample_size total_impressions total_clicks total_conversions " + " ".join(c for c in _V if "revenue" not in c),
        f="total_revenue variant_a_revenue variant_b_revenue",
    ),
    "a13_ab_summary": pick(
        "ab_sum", s="test_status statistical_significance winner confidence_level", i="test_count",
        f="avg_ctr_lift avg_conversion_lift avg_revenue_lift avg_test_duration avg_sample_size_required "
        "significant_test_rate clear_winner_rate actionable_test_rate variant_b_win_rate",
    ),
    "a14_dq_summary": _DQ,
    "a15_audience_summary": pick(
        "aud", s="target_audience", i="campaign_count", f="avg_roas avg_ctr avg_conversion_rate total_campaign_revenue"
    ),
    "a16_ab_by_campaign": pick(
        "ab_camp", s="campaign_id", i="ab_test_count significant_tests", f="avg_ctr_lift avg_conversion_lift"
    ),
    "a17_ab_by_campaign_type": pick(
        "ab_type", s="campaign_type", i="significant_ab_tests", f="avg_ctr_lift avg_conversion_lift"
    ),
    "a18_segment_profile": _profile("rfm_segment"),
    "a19_segment_summary": """
        select rfm_segment as segment, count(*) as customer_count,
               round(cast(sum(monetary_value) as double) / count(*), 6) as avg_monetary_value,
               round(avg(frequency), 6) as avg_frequency, round(avg(recency_days), 6) as avg_recency_days,
               round(avg(engagement_score), 6) as avg_engagement_score,
               case when avg(monetary_value) > 2000 and avg(frequency) > 10 then 'High-Value Loyal'
                    when avg(monetary_value) > 1000 and avg(recency_days) < 30 then 'High-Value Recent'
                    when avg(frequency) > 5 and avg(engagement_score) > 70 then 'Engaged Regular'
                    when avg(recency_days) < 60 and avg(engagement_score) > 50 then 'Recent Engaged'
                    when avg(recency_days) > 180 then 'At Risk' else 'Standard' end as segment_type
        from uni group by 1""",
    "a20_segment_stats": """
        select cast(frequency_score as bigint) as frequency_score,
               round(cast(sum(monetary_value) as double) / count(*), 2) as monetary_value_mean,
               count(*) as monetary_value_count, round(avg(frequency), 2) as frequency_mean,
               round(avg(engagement_score), 2) as engagement_score_mean
        from uni group by 1""",
    "a21_value_counts": "select age_group, count(*) as count from customer_demographics where age_group is not null group by 1",
    "a22_describe": _lines(
        *[_describe(c, "uni") for c in ("monetary_value", "recency_days", "frequency", "avg_order_value")]
    ),
    "a23_summary_stats": """
        with v as (select cast(total_amount as double) as v from txn_ok)
        select cast(count(v) as double) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, min(v) as min,
               max(v) as max, (select cast(sum(total_amount) as double) from txn_ok) as sum,
               round(median(v), 6) as median from v""",
    "a24_rate": "select round(avg((journey_type = 'Converter')::int), 6) as converter_share from jrn",
    "a24_threshold_counts": """select count(*) filter (conversion_probability > 0.7::double) as high_count,
                               count(*) filter (conversion_probability < 0.3::double) as low_count from jrn""",
    "a25_group_size": "select cast(frequency as bigint) as frequency, count(*) as count from rfm group by 1",
    "a26_null_counts": " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as missing from customers"
        for c in (
            "customer_id", "email", "first_name", "last_name", "date_of_birth", "gender", "country", "income_bracket",
            "registration_date", "is_active",
        )
    ),
    "a27_duplicate_rows": """
        select (select count(*) from transactions)
             - (select count(*) from (select distinct customer_id, payment_method, order_status from transactions))
             as duplicate_rows""",
    "a28_master_report": _MASTER,
    "a29_histogram": _histogram("rfm_score", 20, "rfm"),
    "a30_label_mode": """
        select (select journey_type from jrn group by 1 order by count(*) desc, 1 limit 1) as most_common,
               count(distinct journey_type) as label_count from jrn""",
    # windows
    "w1_campaign_ranks": pick("camp_rank", s="campaign_id", i="revenue_rank conversion_rank roas_rank"),
    "w1_rank_within_channel": """
        select campaign_id, channel, round(cast(total_revenue as double), 6) as total_revenue,
               row_number() over (partition by channel order by total_revenue desc nulls last, campaign_id) as channel_rank
        from camp""",
    "w2_latest_per_group": """
        select customer_id, transaction_id, cast(order_date as varchar) as order_date, cast(total_amount as double) as total_amount
        from (select *, row_number() over (partition by customer_id order by order_date desc, transaction_id desc) as rn from txn_ok)
        where rn = 1""",
    "w3_first_per_key": """
        select customer_id, transaction_id, cast(order_date as varchar) as order_date, cast(total_amount as double) as total_amount
        from (select *, row_number() over (partition by customer_id order by order_date, transaction_id) as rn from txn_ok)
        where rn = 1""",
    "w4_rank_curve": """
        select customer_id, round(predicted_revenue, 6) as predicted_revenue,
               row_number() over (order by predicted_revenue desc, customer_id) as customer_rank from sc_rev""",
    "w5_order_gaps": """
        select customer_id, cast(order_day as varchar) as order_day, orders,
               cast(lag(order_day) over w as varchar) as previous_order_day,
               order_day - lag(order_day) over w as gap_days
        from daily window w as (partition by customer_id order by order_day)""",
    "w6_trailing_frames": """
        select customer_id, cast(order_day as varchar) as order_day, round(revenue_ma_7, 6) as revenue_ma_7,
               round(revenue_ma_30, 6) as revenue_ma_30 from lags""",
    # sorts, limits, samples
    "t1_ordered_summary": pick(
        "rfm_show", s="rfm_segment", i="customer_count", f="avg_value avg_orders avg_days_since_purchase"
    ),
    "t2_union_sorted": pick("camp_show", s="summary_type category", f="roas"),
    "t3_dedupe": """
        select test_id, result_id, variant, cast(clicks as bigint) as clicks
        from (select *, row_number() over (partition by test_id order by result_id, variant, clicks) as rn from ab_test_results)
        where rn = 1""",
    "t4_preview": "select customer_id, cast(rfm_score as bigint) as rfm_score from rfm order by customer_id limit 10",
    "t5_top_quantile": """
        with t as (select quantile_cont(predicted_revenue, 0.8) as q from sc_rev)
        select round(any_value(q), 6) as threshold, count(*) filter (predicted_revenue >= q) as high_count,
               round(100 * count(*) filter (predicted_revenue >= q) / count(*), 6) as high_percent,
               round(avg(predicted_revenue) filter (predicted_revenue >= q), 6) as high_mean
        from sc_rev, t""",
    "t5_top_rows": """
        select customer_id, round(predicted_revenue, 6) as predicted_revenue from sc_rev
        where predicted_revenue >= (select quantile_cont(predicted_revenue, 0.8) from sc_rev)""",
    "t6_random_split": _split(f"{_hash()} < 0.7::double", "customer_id", "cust_ok"),
    "t6_exact_split": f"""
        select customer_id, row_number() over (order by {_hash()}, customer_id)
                            <= round(0.7::double * count(*) over ()) as in_first
        from cust_ok""",
    "t7_train_test": _split(f"{_hash()} >= 0.2::double", "customer_id", "cust_ok"),
    "t8_stratified_split": f"""
        select customer_id, rfm_segment,
               case when row_number() over (partition by rfm_segment order by {_hash()}, customer_id)
                         <= round(0.8::double * count(*) over (partition by rfm_segment)) then 'first' else 'second' end as part
        from rfm""",
    "t9_timeline_split": f"""
        select customer_id, cast(registration_date as varchar) as split_ts,
               case when registration_date < {AS_OF} - 90 then 'first' else 'second' end as part
        from cust_ok where registration_date is not null""",
    "t10_best_model": """
        select rfm_segment as best_model, round(avg(engagement_score), 6) as best_score from uni
        group by 1 order by avg(engagement_score) desc, 1 limit 1""",
    # set operations
    "u1_union_counts": """select 'customers' as table_name, count(*) as row_count from cust_ok
                          union all select 'campaigns', count(*) from camp_ok
                          union all select 'ab_tests', count(*) from test_ok""",
    "u2_union_summaries": pick("camp_show", **_SHOW_CAMP),
    # scores, tiers, KPIs
    "m1_recency_score": pick("rfm", s="customer_id", i="recency_days recency_score"),
    "m2_frequency_score": pick("rfm", s="customer_id", i="frequency frequency_score"),
    "m3_monetary_score": pick("rfm", s="customer_id", i="monetary_score", f="monetary_value"),
    "m4_rfm_score": pick("rfm", s="customer_id", i="rfm_score"),
    "m5_rfm_segments": pick("rfm", i=f"{_RFM_I} {_RFM_SCORES}", f=_RFM_F, s=f"{_RFM_S} {_RFM_LABELS}"),
    "m6_value_tier": pick("rfm", s="customer_id customer_value_tier"),
    "m7_engagement_level": pick("rfm", s="customer_id engagement_level"),
    "m8_guarded_ratio": f"""
        select result_id, round({ratio0('clicks', 'impressions')}, 6) + 0.0 as ctr,
               round({ratio0('conversions', 'clicks')}, 6) + 0.0 as conversion_rate from ab_test_results""",
    "m9_performance_segment": pick("camp", s="campaign_id performance_segment", f="overall_roas"),
    "m10_efficiency_score": pick("camp", s="campaign_id", i="efficiency_score"),
    "m11_budget_utilization": pick("camp", s="campaign_id", f="budget_utilization_percent"),
    "m12_duration": "select campaign_id, end_date - start_date as campaign_duration from camp_ok",
    "m13_journey_type": pick("jrn", s="customer_id journey_type"),
    "m14_conversion_status": pick("jrn", s="customer_id conversion_status"),
    "m15_journey_complexity": pick("jrn", s="customer_id journey_complexity"),
    "m16_engagement_score": pick("jrn", s="customer_id", i="engagement_score"),
    "m17_conversion_probability": pick("jrn", s="customer_id", f="conversion_probability"),
    "m18_device_preference": pick("ses", s="customer_id device_preference"),
    "m19_browser_preference": pick("ses", s="customer_id browser_preference"),
    "m20_unmatched_defaults": pick(
        "jrn", s="customer_id device_preference scroll_engagement search_effectiveness",
        i="total_sessions total_page_views total_search_queries",
    ),
    "m21_ab_rates": pick("ab", s="test_id", i="test_duration_days", f=_RATES),
    "m22_ab_lift": pick("ab", s="test_id", f="ctr_lift_percentage conversion_lift_percentage revenue_lift_percentage"),
    "m23_ab_significance": pick("ab", s="test_id statistical_significance confidence_level", f="p_value"),
    "m24_ab_winner": pick("ab", s="test_id winner"),
    "m25_ab_sample_size": pick("ab", s="test_id", i="sample_size_required"),
    "m26_ab_recommend": pick("ab", s="test_id recommendation"),
    "m27_segment_type": """
        select cast(rfm_score as bigint) as segment,
               case when avg(monetary_value) > 2000 and avg(frequency) > 10 then 'High-Value Loyal'
                    when avg(monetary_value) > 1000 and avg(recency_days) < 30 then 'High-Value Recent'
                    when avg(frequency) > 5 and avg(engagement_score) > 70 then 'Engaged Regular'
                    when avg(recency_days) < 60 and avg(engagement_score) > 50 then 'Recent Engaged'
                    when avg(recency_days) > 180 then 'At Risk' else 'Standard' end as segment_type
        from uni group by 1""",
    "m28_campaign_kpis": f"""
        select performance_id, round({ratio0('clicks', 'impressions')}, 4) + 0.0 as ctr,
               round({ratio0('conversions', 'clicks')}, 4) + 0.0 as conversion_rate,
               least(round(cast(revenue as double) / (cast(budget as double) / 365), 2), 999.99::double) as roas
        from perf_ok join camp_ok using (campaign_id)""",
    "m29_age_group": f"""
        select customer_id, case when a < 25 then '18-24' when a < 35 then '25-34' when a < 45 then '35-44'
                                 when a < 55 then '45-54' else '55+' end as age_group
        from (select customer_id, ({AS_OF} - date_of_birth) // 365 as a from customers)""",
    "m30_line_total": """select item_id, product_id, cast(round(total_price * quantity, 2) as double) as line_total
                         from transaction_items""",
    "m31_segment_names": """
        select customer_id, cast(cluster as bigint) as cluster,
               case when cluster = -1 then 'Noise'
                    else 'Segment_' || cast(dense_rank() over (order by cluster) - 1 as varchar) end as segment_type
        from clus""",
    # engineered features
    "f1_age_and_recency": pick("uni", s="customer_id", i="customer_age_days days_since_last_purchase"),
    "f2_purchase_velocity": pick("uni", s="customer_id", f="purchase_velocity"),
    "f3_engagement_normalized": pick("uni", s="customer_id", f="engagement_score_normalized"),
    "f4_session_intensity": pick("uni", s="customer_id", f="session_intensity conversion_efficiency"),
    "f5_behaviour": pick("uni", s="customer_id", f="search_intensity product_exploration cart_behavior"),
    "f6_rfm_composite": pick("uni", s="customer_id", f="rfm_composite value_engagement_ratio"),
    "f7_campaign_response": pick("uni", s="customer_id", f="campaign_response_rate ab_test_impact"),
    "f8_risk_and_potential": pick("uni", s="customer_id", f="churn_risk upsell_potential lifetime_value_potential"),
    "f9_flags": pick("uni", s="customer_id", i="is_high_value is_engaged is_mobile_user is_return_visitor"),
    "f10_fill_typed": pick("uni", s="customer_id age_group interests", i="household_size campaign_count", f="avg_roas"),
    "unified_customers": pick(
        "uni",
        s=f"{_RFM_S} {_RFM_LABELS} age_group education_level interests lifestyle_segment email_journey "
        "first_name_journey last_name_journey target_audience campaign_type dataset_created_at data_version "
        + " ".join(c for c in _JRN_S.split() if c not in _RFM_S.split()),
        i=f"{_RFM_I} {_RFM_SCORES} {_JRN_I} household_size campaign_count significant_ab_tests customer_age_days "
        "days_since_last_purchase is_high_value is_engaged is_mobile_user is_return_visitor",
        f=f"{_RFM_F} {_JRN_F} avg_roas avg_ctr avg_conversion_rate total_campaign_revenue avg_ctr_lift "
        "avg_conversion_lift engagement_score_normalized purchase_velocity session_intensity conversion_efficiency "
        "search_intensity product_exploration cart_behavior rfm_composite value_engagement_ratio "
        "campaign_response_rate ab_test_impact churn_risk upsell_potential lifetime_value_potential",
    ),
    "f11_impute_median": """
        select customer_id,
               round(coalesce(avg_days_between_orders, (select median(avg_days_between_orders) from hist)), 6)
                 as avg_days_between_orders,
               round(coalesce(revenue_90d, (select median(revenue_90d) from hist)), 6) as revenue_90d
        from hist""",
    "f12_impute_mode": """
        select customer_id, coalesce(age_group, (select age_group from customer_demographics where age_group is not null
               group by 1 order by count(*) desc, 1 limit 1)) as age_group from customer_demographics""",
    "f13_clip_iqr": f"select customer_id, {_clip('monetary_value')}, {_clip('frequency')} from rfm",
    "f14_minmax": """
        with m as (select rfm_segment, avg(cast(monetary_value as double)) as v, avg(cast(frequency as double)) as f
                   from uni group by 1)
        select rfm_segment,
               round((v - min(v) over ()) / nullif(max(v) over () - min(v) over (), 0), 6) as monetary_value_normalized,
               round((f - min(f) over ()) / nullif(max(f) over () - min(f) over (), 0), 6) as frequency_normalized
        from m""",
    "f15_standardize": """
        select customer_id,
               round((recency_days - avg(recency_days) over ()) / stddev_pop(recency_days) over (), 6) + 0.0 as recency_days,
               round((frequency - avg(frequency) over ()) / stddev_pop(frequency) over (), 6) + 0.0 as frequency
        from rfm""",
    "f16_cut": f"""
        select customer_id, {bins('p', *SUCCESS)} as success_category, {bins('recency_days', *BUDGET)} as budget_category,
               {bins('recency_days', *ROI)} as roi_category, {bins('p', *STAGE)} as stage_category,
               {bins('p', *CONVERSION)} as conversion_category, {bins('p', *STAGE_COARSE)} as stage_coarse,
               {bins('p', *PROBABILITY_COARSE)} as probability_coarse
        from (select customer_id, recency_days, (recency_days % 111) / 100.0::double as p from rfm)""",
    "f17_cut_equal": """
        select customer_id, cast(recency_days as bigint) as recency_days,
               ['Very Low', 'Low', 'Medium', 'High', 'Very High'][
                 greatest(1, cast(ceil((recency_days - lo) / ((hi - lo) / 5)) as int))] as level
        from rfm, (select min(recency_days)::double as lo, max(recency_days)::double as hi from rfm)""",
    "f18_calendar": """
        select customer_id, cast(registration_date as varchar) as registration_date,
               isodow(registration_date) - 1 as day_of_week, month(registration_date) as month,
               quarter(registration_date) as quarter, year(registration_date) as year from cust_ok""",
    "f19_journey_stage": """
        select customer_id, case when frequency >= 5 then 'loyal_customer' when frequency >= 2 then 'repeat_customer'
               when frequency = 1 then 'first_time_buyer' when cart_adds > 0 then 'cart_abandoner'
               when product_views > 0 then 'product_browser' else 'visitor' end as journey_stage from uni""",
    "f20_conversion_probability": """
        select customer_id, round(least(0.95, 0.1
               + case when rfm_score > 80 then 0.3 when rfm_score > 60 then 0.2 when rfm_score > 40 then 0.1 else 0 end
               + 0.1 * ((total_page_views > 10)::int + (total_events > 5)::int + (total_interactions > 3)::int
                        + (product_views > 5)::int) + 0.2 * (cart_adds > 0)::int), 6)::double as conversion_probability
        from uni""",
    "f21_journey_ratios": f"""
        select customer_id, round(total_sessions / greatest(total_page_views, 1), 6) + 0.0 as avg_session_duration,
               round((total_sessions - total_page_views) / greatest(total_sessions, 1), 6) + 0.0 as bounce_rate,
               round(total_page_views * 0.3::double + total_events * 0.4::double + total_interactions * 0.3::double, 6) + 0.0 as engagement_score,
               {AS_OF} - registration_date as days_since_first_visit,
               round(total_sessions / case when {AS_OF} = registration_date then 1 else {AS_OF} - registration_date end, 6) + 0.0 as visit_frequency,
               round(product_views / greatest(total_sessions, 1), 6) + 0.0 as avg_product_views,
               round(cart_adds / greatest(product_views, 1), 6) + 0.0 as cart_add_rate,
               round(frequency / greatest(cart_adds, 1), 6) + 0.0 as purchase_rate
        from uni""",
    "f22_campaign_labels": """
        select customer_id, case when avg_roas > 3 and avg_ctr > 0.05 then 'high'
                                 when avg_roas > 2 and avg_ctr > 0.03 then 'medium' else 'low' end as campaign_success,
               round(least(1000, greatest(100, cast(total_campaign_revenue as double) * avg_roas / 2)), 6)::double as optimal_budget
        from uni""",
    "f22_history_labels": """
        select customer_id, (avg_roas > (select median(avg_roas) from uni)
                             and avg_ctr > (select median(avg_ctr) from uni))::bigint as label_success,
               round(customer_lifetime_value * 0.1, 6) + 0.0 as label_budget,
               round(cast(monetary_value as double) * (1 + frequency / 10), 6) + 0.0 as label_revenue,
               round(least(0.15, greatest(0.01, 0.05 * (1 + frequency / 10))), 6)::double + 0.0 as label_ctr,
               least(4, frequency // 2)::bigint as label_stage,
               (cast(monetary_value as double) > (select median(cast(monetary_value as double)) from uni))::bigint as label_conversion
        from uni""",
    "f23_order_counts": pick("hist", s="customer_id", i="order_count_30d order_count_90d order_count_365d"),
    "f24_trailing_revenue": pick("hist", s="customer_id", f="revenue_30d revenue_90d revenue_365d"),
    "f25_days_between_orders": """
        select customer_id, round(avg(gap), 6) + 0.0 as avg_days_between_orders
        from (select customer_id, order_date - lag(order_date) over (partition by customer_id order by order_date) as gap from sold)
        group by 1""",
    "f26_order_totals": pick("hist", s="customer_id", i="total_orders days_since_first_order"),
    "f27_simulated_lags": """
        select customer_id, round(m * 0.95, 6) as revenue_lag_1, round(m * 0.9, 6) as revenue_lag_7,
               round(m * 0.85, 6) as revenue_lag_30, round(m * 0.98, 6) as revenue_ma_7, round(m * 0.95, 6) as revenue_ma_30,
               round(avg_ctr, 6) as ctr, round(avg_ctr * 0.95, 6) as ctr_lag_1, round(avg_ctr * 0.98, 6) as ctr_ma_7
        from (select customer_id, cast(monetary_value as double) as m, avg_ctr from uni)""",
    "f27_point_in_time_lags": _known_lags(f"{AS_OF} - cast(recency_days as int)"),
    "f27_scoring_lags": _known_lags(AS_OF),
    "f28_revenue_lags": pick("lags", s="customer_id order_day", f=_LAGS["f"]),
    "f28_latest_lags": pick(
        "(select * from lags qualify row_number() over (partition by customer_id order by order_day desc) = 1)", **_LAGS
    ),
    "f29_roi_and_value": """select customer_id, round(recency_days * 0.15::double, 6) + 0.0 as estimated_roi,
                            round(purchase_frequency_rate * 100, 6) + 0.0 as expected_value from rfm""",
    "f30_campaign_plan": """
        select campaign_id, cast(budget as double) as budget, cast(total_impressions as bigint) as target_audience_size,
               round(cast(budget as double) * 1.2::double, 6) as recommended_budget, 3.5::double as expected_roas,
               cast(floor(total_impressions * 0.05::double) as bigint) as predicted_conversions,
               'Email,Social Media,Search' as optimal_channels from camp""",
    "f31_journey_path": """
        select customer_id, journey,
               case journey when 'purchase' then 'Home,Products,Product Detail' when 'browse' then 'Home,Categories,Product List'
                            when 'search' then 'Home,Search,Search Results' else 'Home,Products' end as predicted_path,
               case when journey = 'purchase' then 0.3::double else 0.1::double end as path_conversion_probability,
               case when journey = 'purchase' then 150.0::double else 0.0::double end as expected_revenue
        from (select customer_id, case when purchase_events > 0 then 'purchase' when total_search_queries > 2 then 'search'
                                       when total_page_views > 0 then 'browse' end as journey from jrn)""",
    "f32_forecast_band": f"""
        select customer_id, round(predicted_revenue, 6) as predicted_revenue, cast({AS_OF} + 30 as varchar) as forecast_date,
               round(predicted_revenue * 0.8, 6) as confidence_lower, round(predicted_revenue * 1.2, 6) as confidence_upper
        from sc_rev""",
    # models
    "l2_density_segments": _density(SEGMENTATION_FEATURES),
    "l2_density_wide_radius": _density(SEGMENTATION_FEATURES, eps=2.5, size=10),
    "l2_density_recency_frequency": _density(["recency_days", "frequency"]),
    "l2_core_distances": _scaled(["recency_days", "frequency"])
    + " select id as customer_id, round(core, 6) as core from core",
    "l2_tree_components": _tree_components(["recency_days", "frequency"], "0.05, 0.1, 0.2, 0.4, 0.8"),
    "l14_stratified_folds": f"""
        select customer_id, least(4, frequency // 2)::bigint as label_stage,
               cast((row_number() over (partition by least(4, frequency // 2) order by {_HASH_42}, customer_id) - 1) % 5 as bigint)
               as fold from uni""",
    "l15_score_density": _density(SEGMENTATION_FEATURES, _NAMED, eps=2.5, size=10),
    "l22_score_all": f"""
        with n as (select count(*) as n from uni where registration_date >= {AS_OF} - 90)
        select family, model, count(*) as models_run, cast(sum(n) as bigint) as total_predictions
        from n, (values ('customer_segmentation', 'kmeans'), ('customer_segmentation', 'density'), ('forecasting', 'revenue'),
                        ('forecasting', 'ctr'), ('journey_simulation', 'journey_stage'),
                        ('journey_simulation', 'conversion_prediction'), ('campaign_optimization', 'campaign_success'),
                        ('campaign_optimization', 'budget_optimization')) as m(family, model)
        group by rollup (family, model)""",
    "s16_model_store": f"select count(*) as customers, cast(0 as bigint) as different from {_RECENT}",
    "l1_kmeans": _one_cluster(_KMEANS, SEGMENTATION_FEATURES, "monetary_value > 0"),
    "l1_kmeans_history": _one_cluster(_KMEANS, [], "true"),
    "l6_success_classifier": _guessed("l6_success_classifier", "campaign_success", _CLASSIFIER),
    "l6_success_classifier_history": _guessed("l6_success_classifier_history", "campaign_success", _CLASSIFIER),
    "l7_budget_regressor": _guessed("l7_budget_regressor", "budget", _REGRESSOR.replace("r2 ", "")),
    "l7_budget_regressor_history": _guessed("l7_budget_regressor_history", "budget", _REGRESSOR),
    "l8_revenue_regressor": _guessed("l8_revenue_regressor", "revenue", _REGRESSOR),
    "l8_revenue_regressor_history": _guessed("l8_revenue_regressor_history", "revenue", _REGRESSOR),
    "l9_ctr_regressor": _guessed("l9_ctr_regressor", "ctr", _REGRESSOR),
    "l9_ctr_regressor_history": _guessed("l9_ctr_regressor_history", "ctr", _REGRESSOR),
    "l10_stage_classifier": _guessed("l10_stage_classifier", "journey_stage", _CLASSIFIER, stratify=True),
    "l10_stage_classifier_history": _guessed("l10_stage_classifier_history", "journey_stage", _CLASSIFIER),
    "l11_conversion_regressor": _guessed("l11_conversion_regressor", "conversion", _REGRESSOR),
    "l11_conversion_classifier_history": _guessed("l11_conversion_classifier_history", "conversion", _CLASSIFIER),
    "l14_cross_validation": _folded("cv_r2", {"n_rows": "count(y)"}, "l7_budget_regressor_history"),
    "l14_cross_validation_accuracy": _folded(
        "cv_accuracy",
        {"n_rows": "count(y)", "baseline_cv_accuracy":
         "avg((y = (select y from dealt group by y order by count(*) desc, y limit 1))::int)"},
        "l11_conversion_classifier_history",
    ),
    "l15_score_segments": _consistent("cast(1 as double) as kmeans_confidence"),
    "l15_score_segments_named": _consistent(),
    "l16_score_revenue": _consistent(_forecast_constants(0.85, "next_month")),
    "l16_score_revenue_levels": _consistent(_forecast_constants(0.85, "next_month")),
    "l17_score_ctr": _consistent(_forecast_constants(0.8, "next_campaign")),
    "l18_score_stage": _consistent(),
    "l18_score_stage_history": _consistent(),
    "l19_score_conversion": _consistent("cast(0.85 as double) as conversion_confidence"),
    "l19_score_conversion_class": _consistent(),
    "l20_score_success": _consistent(),
    "l20_score_success_class": _consistent(),
    "l21_score_budget": _consistent("cast(0.85 as double) as budget_confidence"),
    "l23_segment_requests": _consistent(
        f"cast(0.8 as double) as confidence_score, cast({AS_OF} as varchar) as inference_date", "uni"
    ),
    "l3_silhouette": _SILHOUETTE,
    "l4_calinski_harabasz": """
        select round(((m - (g0 * g0 + g1 * g1) / n) / (k - 1)) / ((q - m) / (n - k)), 6) as calinski_harabasz
        from (select count(*) as k, sum(n) as n, sum(s0) as g0, sum(s1) as g1, sum(q) as q,
                     sum((s0 * s0 + s1 * s1) / n) as m from cl_stat)""",
    "l5_cluster_stats": """
        select count(distinct cluster) filter (cluster <> -1) as n_clusters, count(*) filter (cluster = -1) as n_noise,
               round(count(*) filter (cluster = -1) / count(*), 6) + 0.0 as noise_ratio from clus""",
    "l12_regression_metrics": """
        with e as (select actual_revenue as y, actual_revenue - predicted_revenue as e from sc_rev)
        select round(avg(abs(e)), 6) as mae, round(avg(e * e), 6) as mse, round(sqrt(avg(e * e)), 6) as rmse,
               round(1 - sum(e * e) / sum((y - (select avg(y) from e)) ** 2), 6) as r2 from e""",
    "l13_classification_metrics": """
        select round(sum(hits) / sum(support), 6) as accuracy, round(sum(pr * support) / sum(support), 6) as precision,
               round(sum(re * support) / sum(support), 6) as recall,
               round(sum(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end * support) / sum(support), 6) as f1
        from prf""",
    # reports
    "d1_profile_counts": _lines(
        *[
            f"select 'missing' as section, '{c}' as key, cast(count(*) - count({c}) as varchar) as value from demo_ok"
            for c in ("customer_id", "age_group", "education_level", "household_size", "interests", "lifestyle_segment")
        ],
        "select 'duplicates', 'rows', cast(count(*) - (select count(*) from (select distinct * from demo_ok)) as varchar) from demo_ok",
        *[
            f"select 'feature_category', '{c}', 'demographic_features'"
            for c in ("age_group", "education_level", "household_size", "interests", "lifestyle_segment")
        ],
        *[
            f"select 'value_count', '{c}=' || {c}, cast(count(*) as varchar) from demo_ok where {c} is not null group by {c}"
            for c in ("customer_id", "age_group", "education_level", "interests", "lifestyle_segment")
        ],
    ),
    "d2_rfm_display": pick(
        "rfm_show", s="rfm_segment", i="customer_count", f="avg_value avg_orders avg_days_since_purchase"
    ),
    "d3_dq_summary": _DQ,
    "d4_campaign_display": pick("camp_show", **_SHOW_CAMP),
    "d5_journey_display": pick(
        "jrn_show", s="journey_type conversion_status", i="session_count",
        f="avg_engagement conversion_rate_percent cart_add_rate_percent",
    ),
    "d6_ab_display": pick(
        "ab_show", s="test_status statistical_significance winner", i="test_count",
        f="avg_ctr_lift_percent avg_conversion_lift_percent significant_test_rate_percent clear_winner_rate_percent",
    ),
    "d7_segment_report": _lines(
        *_summary("summary", "demo_seg", total_customers="count(*)", segments_found="count(distinct cluster)"),
        _group("segment_distribution", "cluster", "demo_seg"),
        _group("segment_type_distribution", "demo_segment_type", "demo_seg"),
        *[
            f"select '{m}', cast(cluster as varchar), round(avg({m}), 6) from demo_seg group by cluster"
            for m in ("demo_avg_monetary", "demo_avg_frequency")
        ],
    ),
    "d8_forecast_report": _forecast(),
    "d9_journey_report_stage": _lines(
        *_confidence("sc_stage", "stage_confidence"),
        _group("stage_distribution", "predicted_journey_stage", "sc_stage"),
        """select 'most_common_stage', (select predicted_journey_stage from sc_stage group by 1 order by count(*) desc, 1 limit 1),
           cast(count(distinct predicted_journey_stage) as double) from sc_stage""",
        _group("category_distribution", "stage_category", "sc_stage"),
    ),
    "d9_journey_report_conversion": _lines(
        *_confidence("sc_conv", "conversion_confidence"),
        *_summary(
            "summary", "sc_conv", avg_conversion_probability="avg(predicted_conversion_probability)",
            high_conversion_customers="count(*) filter (predicted_conversion_probability > 0.7::double)",
            low_conversion_customers="count(*) filter (predicted_conversion_probability < 0.3::double)",
        ),
        _group("category_distribution", "conversion_category", "sc_conv"),
    ),
    "d10_campaign_report_success": _lines(
        *_confidence("sc_succ", "success_confidence"),
        *_summary(
            "summary", "sc_succ",
            predicted_success_rate="100 * avg((predicted_campaign_success = 'high')::int)",
            avg_success_probability="avg(success_probability)",
        ),
        _group("success_distribution", "predicted_campaign_success", "sc_succ"),
        _group("category_distribution", "success_category", "sc_succ"),
    ),
    "d10_campaign_report_budget": _lines(
        *_confidence("sc_bud", "budget_confidence"),
        *_summary(
            "summary", "sc_bud", total_predicted_budget="sum(predicted_optimal_budget)",
            avg_predicted_budget="avg(predicted_optimal_budget)", total_estimated_roi="sum(estimated_roi)",
        ),
        _group("category_distribution", "budget_category", "sc_bud"),
    ),
    "d10_probability_report": _lines(
        *_summary(
            "summary", "sc_conv", total_customers="count(*)", mean="avg(predicted_conversion_probability::double)",
            median="median(predicted_conversion_probability::double)",
            std="stddev_samp(predicted_conversion_probability::double)",
        ),
        _group("category_distribution", bins("predicted_conversion_probability", *PROBABILITY_COARSE), "sc_conv"),
        _group("prediction_distribution", "(predicted_conversion_probability > 0.5::double)::int", "sc_conv"),
    ),
    "d11_master_report": _MASTER,
    "d13_chart_scatter": f"""
        select customer_id, cast(recency_days as bigint) as recency_days, cast(monetary_value as double) as monetary_value
        from uni where {_hash()} < 0.5::double""",
    "d12_training_report_rows": _report_rows(),
    "d13_chart_histogram": _histogram("predicted_revenue", 50, "sc_rev"),
    "d13_chart_radar": """
        with m as (select rfm_segment, avg(cast(monetary_value as double)) as monetary_value, avg(frequency) as frequency,
                          avg(engagement_score) as engagement_score, avg(customer_lifetime_value) as customer_lifetime_value,
                          avg(purchase_velocity) as purchase_velocity from uni group by 1)
        select rfm_segment, """
    + ", ".join(
        f"round({c}, 6) + 0.0 as {c}, round(({c} - min({c}) over ()) / nullif(max({c}) over () - min({c}) over (), 0), 6) + 0.0 as {c}_normalized"
        for c in ("monetary_value", "frequency", "engagement_score", "customer_lifetime_value", "purchase_velocity")
    )
    + " from m",
    "d14_table_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in VIEWS if t not in ("click_base", "item_lines")
    ),
    # data quality
    "dq1_key_violations": """select item_id, count(*) as row_count from transaction_items where item_id is not null
                             group by 1 having count(*) > 1""",
    "dq1_composite_key": """select customer_id, cast(order_date as varchar) as order_date, count(*) as row_count
                            from transactions group by 1, 2 having count(*) > 1""",
    "dq2_required": " union all ".join(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as violations from page_views"
        for c in ("view_id", "session_id", "page_url", "timestamp")
    ),
    "dq3_orphans": """select test_id, campaign_id from ab_tests
                      where campaign_id not in (select campaign_id from camp_ok)""",
    "dq4_cascade": """select customer_id, cast(household_size as bigint) as household_size from customer_demographics
                      where customer_id in (select customer_id from cust_ok)""",
    "dq4_set_null": """select transaction_id, case when customer_id in (select customer_id from cust_ok)
                       then customer_id end as customer_id from transactions""",
    "dq5_domain": "select result_id, variant from ab_test_results where variant <> 'A' and variant <> 'B'",
    "dq6_customer_rejects": f"""
        select customer_id, concat_ws(',', case when email is null then 'email_missing' end,
                 case when email is null or email not like '%@%' then 'email_malformed' end,
                 case when registration_date > {AS_OF} then 'registered_in_future' end) as failed_rules
        from customers where email is null or email not like '%@%' or registration_date > {AS_OF}""",
    "dq6_campaign_rejects": """
        select campaign_id, concat_ws(',', case when end_date < start_date then 'ends_before_start' end,
                 case when budget <= 0 then 'budget_not_positive' end) as failed_rules
        from campaigns where end_date < start_date or budget <= 0""",
    "dq7_defaults": """select campaign_id, case when status = 'Paused' then 'Active' else status end as status from campaigns""",
    "dq7_touch": """
        select campaign_id, case when status = 'Paused' then 'Active' else status end as status,
               case when status = 'Paused' then '2001-08-02' else '2001-01-01' end as updated_at from campaigns""",
}


def oracle_sql() -> dict[str, str]:
    """Query name to complete SQL text."""
    return {name: _complete(text) for name, text in ORACLES.items()}


def _complete(text: str) -> str:
    """A query that opens its own WITH is continued after the relations it needs."""
    names = _needed(text)
    body = ",\n".join(f"{name} as ({CTES[name]})" for name in names)
    stripped = text.strip()
    if stripped.startswith("/*recursive*/"):
        return f"with recursive {body}{stripped.removeprefix('/*recursive*/')}"
    if not names:
        return stripped
    if stripped.startswith("with "):
        return f"with {body},\n{stripped.removeprefix('with ')}"
    return f"with {body}\n{stripped}"

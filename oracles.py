"""The queries as SQL for another engine, to check the Spark results.

Written row by row from the definitions, without the pre-aggregation and join
order the Spark plans use, so the two sides fail independently.
"""

from __future__ import annotations

import re

AS_OF = "2001-01-01 00:00:00"
CLIENT = 3
WEEK_START = "1998-06-01"
LAST_DAY = "1998-06-30"
LOW_CTR = 33.0
LEAST_SEEN = 10
FEW_CLICKS = 0.2


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF({whole}, 0)"


def pct(part: str, whole: str) -> str:
    return rnd(f"{ratio(part, whole)} * 100", 2)


def iff(condition: str) -> str:
    return f"COUNT(CASE WHEN {condition} THEN 1 END)"


_SEARCHER = "CASE WHEN o_custkey % 100 = 7 THEN NULL ELSE o_custkey END"
_SEARCH_TS = "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR"
_EVENT_ID = "concat_ws('-', l_orderkey, l_partkey, l_linenumber, l_suppkey)"
_IS_BOT = "CASE WHEN l_tax = 0 THEN 'True' ELSE 'False' END"

CTES: dict[str, str] = {
    # raw
    "raw_searches": f"""
        SELECT o_orderkey AS search_guid, {_SEARCHER} AS visitor_id, o_orderpriority AS search_query,
            CASE WHEN o_orderkey % 50 = 0 THEN 'homepage_banner' WHEN o_orderstatus = 'F' THEN 'featured_jobs'
                ELSE 'search_results' END AS sublocation,
            CASE WHEN o_orderkey % 3 = 0 THEN 'relevance' ELSE 'recency' END AS sort,
            CAST(1 + o_orderkey % 10 AS INT) AS page, {_SEARCH_TS} AS event_ts
        FROM orders""",
    "raw_impressions": f"""
        SELECT {_EVENT_ID} AS event_id, {_SEARCHER} AS visitor_id, l_orderkey AS search_guid,
            CASE WHEN l_partkey % 53 = 7 THEN l_partkey + 1 ELSE l_partkey END AS opening_uid,
            l_linenumber AS position, {_SEARCH_TS} AS event_ts,
            l_shipdate AS collector_ts, {_IS_BOT} AS is_bot
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_clicks": f"""
        SELECT {_EVENT_ID} AS event_id, {_SEARCHER} AS visitor_id, l_orderkey AS search_guid,
            CASE WHEN l_orderkey % 97 = 3 THEN NULL ELSE l_partkey END AS opening_uid,
            l_linenumber AS position,
            {_SEARCH_TS} + CAST(l_quantity AS INT) * INTERVAL '1' SECOND AS event_ts,
            l_shipdate AS collector_ts, {_IS_BOT} AS is_bot,
            CASE CAST(l_quantity AS INT) WHEN 50 THEN 'instant' WHEN 49 THEN 'fast' WHEN 48 THEN '-5'
                ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS time_to_click_secs
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "raw_jobs": """
        SELECT p_partkey AS opening_uid, p_name AS title, p_type AS category, p_brand AS budget_type,
            CASE WHEN p_size = 50 THEN 'negotiable' ELSE CAST(p_retailprice AS VARCHAR) END AS budget_amount,
            p_partkey % ((SELECT COUNT(*) FROM supplier) - 1) AS client_uid,
            DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS posted_at, p_size <= 40 AS is_active
        FROM part""",
    "raw_clients": """
        SELECT s_suppkey AS client_uid, s_name AS company_name, n_name AS country,
            CASE s_suppkey % 4 WHEN 0 THEN 'IT & Networking' WHEN 1 THEN 'Design & Creative'
                WHEN 2 THEN 'Marketing & Sales' ELSE 'Business Consulting' END AS industry,
            s_suppkey % 5 <> 0 AS payment_verified,
            CASE WHEN s_suppkey % 10 = 9 THEN 'not disclosed' ELSE CAST(s_acctbal AS VARCHAR) END AS total_spend_usd,
            DATE '2017-01-01' + CAST(s_suppkey % 1000 AS INT) AS member_since,
            CAST(CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 3.0 + (s_suppkey % 20) / 10.0 END AS DOUBLE) AS avg_rating
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_freelancers": """
        SELECT c_custkey AS visitor_id, c_name AS name, n_name AS country, c_mktsegment AS primary_skill,
            CASE WHEN c_custkey % 20 = 3 THEN 'negotiable' ELSE CAST(20 + c_custkey % 60 AS VARCHAR) END AS hourly_rate,
            CASE WHEN c_custkey % 8 = 5 THEN 'N/A' ELSE CAST(c_custkey % 100 AS VARCHAR) END AS job_success_score,
            DATE '2016-01-01' + CAST(c_custkey % 1500 AS INT) AS member_since,
            c_acctbal > 5000 AS top_rated, c_custkey % 6 <> 0 AS is_verified
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "audit_log": """
        SELECT event_id, ts AS event_time, concat('user', user_id, '@example.com') AS user_email,
            CASE event_type WHEN 'view' THEN 'SELECT' WHEN 'click' THEN 'CREATE TABLE' WHEN 'signup' THEN 'ALTER TABLE'
                WHEN 'purchase' THEN 'GRANT' ELSE 'LOGIN' END AS action_name,
            concat(CASE WHEN user_id % 3 = 0 THEN 'sandbox.' ELSE 'market.gold.' END, 'table_', user_id % 20) AS table_name
        FROM events""",
    # silver
    "typed_impressions": "SELECT * REPLACE (is_bot = 'True' AS is_bot) FROM raw_impressions",
    "typed_clicks": """
        SELECT * REPLACE (is_bot = 'True' AS is_bot, TRY_CAST(time_to_click_secs AS DOUBLE) AS time_to_click_secs)
        FROM raw_clicks""",
    "searches": """
        SELECT * FROM raw_searches WHERE visitor_id IS NOT NULL AND search_guid IS NOT NULL
            AND sublocation IN ('search_results', 'featured_jobs')""",
    "impressions": """
        SELECT * FROM typed_impressions WHERE visitor_id IS NOT NULL AND search_guid IS NOT NULL
            AND opening_uid IS NOT NULL AND position IS NOT NULL AND NOT is_bot""",
    "clicks": """
        SELECT * FROM typed_clicks WHERE visitor_id IS NOT NULL AND search_guid IS NOT NULL
            AND opening_uid IS NOT NULL AND position IS NOT NULL AND time_to_click_secs IS NOT NULL AND NOT is_bot""",
    "jobs": """
        SELECT * EXCLUDE (budget_amount), TRY_CAST(budget_amount AS DOUBLE) AS numeric_budget_amount FROM raw_jobs""",
    "clients": "SELECT *, TRY_CAST(total_spend_usd AS DOUBLE) AS numeric_total_spend_usd FROM raw_clients",
    "freelancers": """
        SELECT *, TRY_CAST(hourly_rate AS DOUBLE) AS numeric_hourly_rate,
            TRY_CAST(job_success_score AS DOUBLE) AS numeric_job_success_score
        FROM raw_freelancers""",
    # quality log
    "flow_rules": f"""
        SELECT date_trunc('day', event_ts) AS run, 'silver.search_events' AS flow, r.name AS rule, r.ord AS ord,
            CASE r.name WHEN 'valid_visitor_id' THEN visitor_id IS NOT NULL
                WHEN 'valid_search_guid' THEN search_guid IS NOT NULL
                ELSE COALESCE(sublocation IN ('search_results', 'featured_jobs'), false) END AS ok
        FROM raw_searches, (VALUES ('valid_visitor_id', 1), ('valid_search_guid', 2), ('valid_sublocation', 3)) r(name, ord)
        UNION ALL
        SELECT date_trunc('day', event_ts), 'silver.impression_events', r.name, r.ord,
            CASE r.name WHEN 'valid_visitor_id' THEN visitor_id IS NOT NULL
                WHEN 'valid_search_guid' THEN search_guid IS NOT NULL
                WHEN 'valid_opening_uid' THEN opening_uid IS NOT NULL
                WHEN 'valid_position' THEN position IS NOT NULL ELSE NOT is_bot END
        FROM typed_impressions, (VALUES ('valid_visitor_id', 1), ('valid_search_guid', 2), ('valid_opening_uid', 3),
            ('valid_position', 4), ('valid_visitors', 5)) r(name, ord)
        UNION ALL
        SELECT date_trunc('day', event_ts), 'silver.click_events', r.name, r.ord,
            CASE r.name WHEN 'valid_visitor_id' THEN visitor_id IS NOT NULL
                WHEN 'valid_search_guid' THEN search_guid IS NOT NULL
                WHEN 'valid_opening_uid' THEN opening_uid IS NOT NULL
                WHEN 'valid_position' THEN position IS NOT NULL
                WHEN 'valid_time_to_click_secs' THEN time_to_click_secs IS NOT NULL ELSE NOT is_bot END
        FROM typed_clicks, (VALUES ('valid_visitor_id', 1), ('valid_search_guid', 2), ('valid_opening_uid', 3),
            ('valid_position', 4), ('valid_time_to_click_secs', 5), ('valid_visitors', 6)) r(name, ord)""",
    "rule_log": f"""
        SELECT run, flow, rule, ord, {iff('ok')} AS passed, {iff('NOT ok')} AS failed
        FROM flow_rules GROUP BY run, flow, rule, ord""",
    "flow_rows": """
        SELECT date_trunc('day', event_ts) AS run, 'silver.search_events' AS flow,
            visitor_id IS NOT NULL AND sublocation IN ('search_results', 'featured_jobs') AS kept FROM raw_searches
        UNION ALL
        SELECT date_trunc('day', event_ts), 'silver.impression_events', visitor_id IS NOT NULL AND NOT is_bot
        FROM typed_impressions
        UNION ALL
        SELECT date_trunc('day', event_ts), 'silver.click_events', visitor_id IS NOT NULL AND opening_uid IS NOT NULL
            AND time_to_click_secs IS NOT NULL AND NOT is_bot FROM typed_clicks""",
    "flow_log": f"""
        SELECT run, flow, {iff('kept')} AS passed, {iff('NOT kept')} AS dropped FROM flow_rows GROUP BY run, flow""",
    # marts, first family
    "p_job_performance": f"""
        SELECT j.opening_uid, title, category, budget_type, numeric_budget_amount, client_uid, posted_at, is_active,
            impressions, unique_visitors_shown, avg_impression_position, clicks, unique_visitors_clicked,
            {pct('clicks', 'impressions')} AS ctr_pct, avg_time_to_click_secs, median_time_to_click_secs
        FROM jobs j
        LEFT JOIN (SELECT opening_uid, COUNT(event_id) AS impressions,
                COUNT(DISTINCT visitor_id) AS unique_visitors_shown,
                {rnd('AVG(position)', 1)} AS avg_impression_position FROM impressions GROUP BY 1) i
            ON j.opening_uid = i.opening_uid
        LEFT JOIN (SELECT opening_uid, COUNT(event_id) AS clicks, COUNT(DISTINCT visitor_id) AS unique_visitors_clicked,
                {rnd('AVG(time_to_click_secs)', 1)} AS avg_time_to_click_secs,
                {rnd('QUANTILE_DISC(time_to_click_secs, 0.5)', 1)} AS median_time_to_click_secs
                FROM clicks GROUP BY 1) c ON j.opening_uid = c.opening_uid""",
    "p_search_query_performance": f"""
        SELECT i.*, clicks, {pct('clicks', 'impressions')} AS ctr_pct
        FROM (SELECT search_query, COUNT(event_id) AS impressions, COUNT(DISTINCT i.visitor_id) AS unique_visitors,
                COUNT(DISTINCT opening_uid) AS unique_jobs_shown, COUNT(DISTINCT i.search_guid) AS search_sessions
            FROM impressions i LEFT JOIN searches s ON i.search_guid = s.search_guid GROUP BY 1) i
        LEFT JOIN (SELECT search_query, COUNT(event_id) AS clicks FROM clicks c
            LEFT JOIN (SELECT DISTINCT search_guid, search_query FROM searches) s ON c.search_guid = s.search_guid
            GROUP BY 1) c ON i.search_query = c.search_query""",
    "p_position_ctr": f"""
        SELECT i.position, impressions, clicks, avg_time_to_click_secs, {pct('clicks', 'impressions')} AS ctr_pct
        FROM (SELECT position, COUNT(event_id) AS impressions FROM impressions GROUP BY 1) i
        LEFT JOIN (SELECT position, COUNT(event_id) AS clicks,
            {rnd('AVG(time_to_click_secs)', 1)} AS avg_time_to_click_secs FROM clicks GROUP BY 1) c
            ON i.position = c.position""",
    "p_category_performance": f"""
        SELECT j.*, impressions, unique_visitors, clicks, {pct('clicks', 'impressions')} AS ctr_pct
        FROM (SELECT category, COUNT(opening_uid) AS job_count,
                {rnd('AVG(numeric_budget_amount)', 2)} AS avg_budget_amount, {iff('is_active')} AS active_jobs
            FROM jobs GROUP BY 1) j
        LEFT JOIN (SELECT category, COUNT(event_id) AS impressions, COUNT(DISTINCT visitor_id) AS unique_visitors
            FROM impressions i LEFT JOIN jobs j ON i.opening_uid = j.opening_uid GROUP BY 1) i ON j.category = i.category
        LEFT JOIN (SELECT category, COUNT(event_id) AS clicks
            FROM clicks c LEFT JOIN jobs j ON c.opening_uid = j.opening_uid GROUP BY 1) c ON j.category = c.category""",
    "p_sublocation_performance": f"""
        SELECT i.*, clicks, avg_time_to_click_secs, {pct('clicks', 'impressions')} AS ctr_pct
        FROM (SELECT sublocation, COUNT(event_id) AS impressions, COUNT(DISTINCT i.visitor_id) AS unique_visitors,
                COUNT(DISTINCT opening_uid) AS unique_jobs, {rnd('AVG(position)', 1)} AS avg_position
            FROM impressions i LEFT JOIN searches s ON i.search_guid = s.search_guid GROUP BY 1) i
        LEFT JOIN (SELECT sublocation, COUNT(event_id) AS clicks,
                {rnd('AVG(time_to_click_secs)', 1)} AS avg_time_to_click_secs FROM clicks c
            LEFT JOIN (SELECT DISTINCT search_guid, sublocation FROM searches) s ON c.search_guid = s.search_guid
            GROUP BY 1) c ON i.sublocation = c.sublocation""",
    "p_daily_metrics": f"""
        SELECT i.*, clicks, avg_time_to_click_secs, {pct('clicks', 'impressions')} AS ctr_pct
        FROM (SELECT CAST(s.event_ts AS DATE) AS event_date, COUNT(event_id) AS impressions,
                COUNT(DISTINCT i.visitor_id) AS unique_visitors, COUNT(DISTINCT i.search_guid) AS search_sessions,
                COUNT(DISTINCT opening_uid) AS unique_jobs_shown
            FROM impressions i LEFT JOIN searches s ON i.search_guid = s.search_guid GROUP BY 1) i
        LEFT JOIN (SELECT CAST(event_ts AS DATE) AS event_date, COUNT(event_id) AS clicks,
            {rnd('AVG(time_to_click_secs)', 1)} AS avg_time_to_click_secs FROM clicks GROUP BY 1) c
            ON i.event_date = c.event_date""",
    "distinct_by_period": " UNION ALL ".join(
        f"SELECT '{grain}' AS grain, CAST(date_trunc('{grain}', s.event_ts) AS DATE) AS period_start, "
        "COUNT(DISTINCT i.visitor_id) AS unique_visitors, COUNT(DISTINCT i.search_guid) AS search_sessions, "
        "COUNT(DISTINCT opening_uid) AS unique_jobs_shown "
        "FROM impressions i LEFT JOIN searches s ON i.search_guid = s.search_guid GROUP BY 1, 2"
        for grain in ("day", "week", "month")
    ),
    # marts, second family
    "s_dim_job_openings": """
        SELECT opening_uid, client_uid, title, category, budget_type, numeric_budget_amount, is_active, posted_at
        FROM jobs""",
    "s_dim_clients": """
        SELECT client_uid, company_name, industry, payment_verified, avg_rating, numeric_total_spend_usd FROM clients""",
    "s_dim_freelancers": """
        SELECT visitor_id, name, country, primary_skill, member_since, top_rated, is_verified, numeric_hourly_rate,
            numeric_job_success_score FROM freelancers""",
    "s_fact_search_funnel": """
        SELECT s.search_guid, s.visitor_id, s.search_query, s.sublocation, s.event_ts AS search_ts,
            i.event_id AS impression_id, i.opening_uid, i.position, c.event_id AS click_id, c.time_to_click_secs
        FROM searches s
        LEFT JOIN impressions i ON s.search_guid = i.search_guid
        LEFT JOIN clicks c ON i.search_guid = c.search_guid AND i.opening_uid = c.opening_uid""",
    "s_job_performance_ctr": f"""
        SELECT f.opening_uid, title, client_uid, COUNT(impression_id) AS impressions,
            COUNT(DISTINCT visitor_id) AS unique_impression_visitors,
            {rnd('AVG(position)', 1)} AS avg_impression_position, COUNT(click_id) AS clicks,
            COUNT(DISTINCT CASE WHEN click_id IS NOT NULL THEN visitor_id END) AS unique_click_visitors,
            {rnd('AVG(time_to_click_secs)', 1)} AS avg_click_time,
            QUANTILE_CONT(time_to_click_secs, 0.25) AS click_time_p25,
            QUANTILE_CONT(time_to_click_secs, 0.5) AS click_time_p50,
            QUANTILE_CONT(time_to_click_secs, 0.75) AS click_time_p75,
            {pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct
        FROM s_fact_search_funnel f LEFT JOIN jobs j ON f.opening_uid = j.opening_uid
        GROUP BY f.opening_uid, title, client_uid""",
    "s_impression_position_ctr": f"""
        SELECT position AS page_position, COUNT(impression_id) AS impressions, COUNT(click_id) AS clicks,
            {pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct,
            {rnd('AVG(time_to_click_secs)', 1)} AS avg_click_time
        FROM s_fact_search_funnel WHERE position IS NOT NULL GROUP BY position""",
    "s_search_query_performance": f"""
        SELECT search_query, COUNT(impression_id) AS impressions, COUNT(DISTINCT visitor_id) AS unique_visitors,
            COUNT(DISTINCT opening_uid) AS unique_jobs_shown, COUNT(DISTINCT search_guid) AS search_sessions,
            COUNT(click_id) AS clicks, {pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct
        FROM s_fact_search_funnel WHERE search_query IS NOT NULL GROUP BY search_query""",
    "s_category_performance": f"""
        SELECT j.*, impressions, unique_visitors, clicks, {pct('clicks', 'impressions')} AS ctr_pct
        FROM (SELECT category, COUNT(opening_uid) AS job_count, {rnd('AVG(numeric_budget_amount)', 2)} AS avg_budget,
            {iff('is_active')} AS active_jobs FROM jobs GROUP BY 1) j
        LEFT JOIN (SELECT category, COUNT(impression_id) AS impressions, COUNT(DISTINCT visitor_id) AS unique_visitors,
            COUNT(click_id) AS clicks FROM s_fact_search_funnel f LEFT JOIN jobs j ON f.opening_uid = j.opening_uid
            GROUP BY 1) f ON j.category = f.category""",
    "s_sublocation_performance": f"""
        SELECT sublocation, COUNT(impression_id) AS impressions, COUNT(DISTINCT visitor_id) AS unique_visitors,
            COUNT(DISTINCT opening_uid) AS unique_jobs, {rnd('AVG(position)', 1)} AS avg_position,
            COUNT(click_id) AS clicks, {rnd('AVG(time_to_click_secs)', 1)} AS avg_click_time,
            {pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct
        FROM s_fact_search_funnel WHERE sublocation IS NOT NULL GROUP BY sublocation""",
    "s_daily_metrics": f"""
        SELECT CAST(search_ts AS DATE) AS event_date, COUNT(impression_id) AS impressions,
            COUNT(DISTINCT visitor_id) AS unique_visitors, COUNT(DISTINCT search_guid) AS search_sessions,
            COUNT(DISTINCT opening_uid) AS unique_jobs_shown, COUNT(click_id) AS clicks,
            {rnd('AVG(time_to_click_secs)', 1)} AS avg_click_time,
            {pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct
        FROM s_fact_search_funnel GROUP BY 1""",
    "s_visitor_engagement": """
        SELECT visitor_id, COUNT(impression_id) AS total_impressions, COUNT(DISTINCT search_guid) AS total_searches,
            COUNT(DISTINCT opening_uid) AS unique_jobs_seen FROM s_fact_search_funnel GROUP BY 1""",
    "s_job_click_engagement": f"""
        SELECT opening_uid, COUNT(click_id) AS total_clicks, COUNT(DISTINCT visitor_id) AS unique_clickers,
            {rnd('AVG(time_to_click_secs)', 2)} AS avg_time_to_click,
            QUANTILE_CONT(time_to_click_secs, 0.25) AS click_time_p25,
            QUANTILE_CONT(time_to_click_secs, 0.5) AS click_time_p50,
            QUANTILE_CONT(time_to_click_secs, 0.75) AS click_time_p75
        FROM s_fact_search_funnel WHERE click_id IS NOT NULL GROUP BY 1""",
    "s_search_to_click_conversion": f"""
        SELECT search_query, sublocation, COUNT(DISTINCT search_guid) AS searches_with_clicks,
            COUNT(click_id) AS total_clicks, {rnd('AVG(time_to_click_secs)', 2)} AS avg_time_to_click
        FROM s_fact_search_funnel WHERE click_id IS NOT NULL GROUP BY 1, 2""",
    "s_hourly_activity": """
        SELECT CAST(EXTRACT(hour FROM search_ts) AS INT) AS hour_of_day, COUNT(impression_id) AS impressions,
            COUNT(DISTINCT visitor_id) AS unique_visitors FROM s_fact_search_funnel GROUP BY 1""",
    # star schema
    "dim_job": """
        SELECT opening_uid, title, category, budget_type, numeric_budget_amount, client_uid, posted_at, is_active
        FROM jobs""",
    "dim_client": """
        SELECT c.client_uid, company_name, country, industry, payment_verified, numeric_total_spend_usd, avg_rating,
            jobs_posted, first_posted_at, latest_posted_at
        FROM clients c LEFT JOIN (SELECT client_uid, COUNT(opening_uid) AS jobs_posted,
            MIN(posted_at) AS first_posted_at, MAX(posted_at) AS latest_posted_at FROM jobs GROUP BY 1) a
            ON c.client_uid = a.client_uid""",
    "dim_category": f"""
        SELECT category, COUNT(opening_uid) AS total_jobs, {rnd('AVG(numeric_budget_amount)', 2)} AS avg_budget_amount
        FROM jobs GROUP BY 1""",
    "dim_freelancer": """
        SELECT visitor_id, name, country, primary_skill, numeric_hourly_rate, numeric_job_success_score, member_since,
            top_rated, is_verified FROM freelancers""",
    "dim_date": """
        SELECT d AS date_key, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
            CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day_of_month,
            CAST(dayofweek(d) + 1 AS INT) AS day_of_week, CAST(weekofyear(d) AS INT) AS week_of_year,
            dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT DISTINCT CAST(event_ts AS DATE) AS d FROM searches)""",
    "dim_search": "SELECT search_guid, visitor_id, search_query, sublocation, sort, page, event_ts FROM searches",
    "first_clicks": """
        SELECT visitor_id, opening_uid, search_guid, time_to_click_secs FROM clicks
        QUALIFY ROW_NUMBER() OVER (PARTITION BY visitor_id, opening_uid, search_guid ORDER BY event_ts, event_id) = 1""",
    "fact_search_events": """
        SELECT i.event_id, CAST(s.event_ts AS DATE) AS event_date, i.opening_uid, i.visitor_id, i.search_guid,
            s.search_query, i.position, s.sublocation, s.event_ts, i.collector_ts,
            c.visitor_id IS NOT NULL AS was_clicked, c.time_to_click_secs
        FROM impressions i LEFT JOIN searches s ON i.search_guid = s.search_guid
        LEFT JOIN first_clicks c ON i.visitor_id = c.visitor_id AND i.opening_uid = c.opening_uid
            AND i.search_guid = c.search_guid""",
    # reports
    "client_posting_performance": f"""
        SELECT client_uid, COALESCE(company_name, CAST(client_uid AS VARCHAR)) AS company_name, opening_uid, title,
            category, budget_type, {rnd('numeric_budget_amount', 2)} AS budget_amount, is_active,
            impressions, clicks, ctr_pct, avg_impression_position, avg_time_to_click_secs,
            CASE WHEN impressions >= 20 AND ctr_pct < 2 THEN 'High visibility, low engagement'
                WHEN impressions < 10 AND ctr_pct >= 5 THEN 'Low visibility, strong engagement'
                WHEN is_active AND clicks = 0 THEN 'Active posting needs attention'
                ELSE 'Steady performance' END AS opportunity_segment,
            CASE WHEN impressions >= 20 AND ctr_pct < 2 THEN 'Refresh title or posting copy'
                WHEN impressions < 10 AND ctr_pct >= 5 THEN 'Increase visibility or distribution'
                WHEN is_active AND clicks = 0 THEN 'Review budget and targeting'
                ELSE 'Maintain current strategy' END AS recommended_action
        FROM (SELECT j.client_uid, c.company_name, j.opening_uid, j.title, j.category, j.budget_type,
                j.numeric_budget_amount, j.is_active, COALESCE(p.impressions, 0) AS impressions,
                COALESCE(p.clicks, 0) AS clicks, COALESCE(p.ctr_pct, 0) AS ctr_pct, p.avg_impression_position,
                p.avg_time_to_click_secs
            FROM jobs j LEFT JOIN p_job_performance p ON j.opening_uid = p.opening_uid
            LEFT JOIN clients c ON j.client_uid = c.client_uid)""",
    "client_category_benchmark": f"""
        SELECT o.client_uid, COALESCE(c.company_name, CAST(o.client_uid AS VARCHAR)) AS company_name, o.category,
            client_jobs, client_active_jobs, client_impressions, client_clicks, {rnd('own_ctr', 2)} AS client_ctr_pct,
            {rnd('own_budget', 2)} AS client_avg_budget_amount, m.impressions AS marketplace_impressions,
            m.clicks AS marketplace_clicks, m.ctr_pct AS marketplace_ctr_pct,
            m.avg_budget_amount AS marketplace_avg_budget_amount, {rnd('own_ctr - m.ctr_pct', 2)} AS ctr_gap_pct,
            {rnd('own_budget - m.avg_budget_amount', 2)} AS budget_gap_amount
        FROM (SELECT j.client_uid, j.category, COUNT(DISTINCT j.opening_uid) AS client_jobs,
                {iff('j.is_active')} AS client_active_jobs, {total('COALESCE(p.impressions, 0)')} AS client_impressions,
                {total('COALESCE(p.clicks, 0)')} AS client_clicks,
                {ratio('SUM(COALESCE(p.clicks, 0))', 'SUM(COALESCE(p.impressions, 0))')} * 100 AS own_ctr,
                AVG(j.numeric_budget_amount) AS own_budget
            FROM jobs j LEFT JOIN p_job_performance p ON j.opening_uid = p.opening_uid GROUP BY 1, 2) o
        LEFT JOIN p_category_performance m ON o.category = m.category
        LEFT JOIN clients c ON o.client_uid = c.client_uid""",
    "client_opportunities": """
        SELECT p.client_uid, p.company_name, p.opening_uid, p.title, p.category, p.is_active, p.impressions, p.clicks,
            p.ctr_pct, p.budget_amount, b.marketplace_ctr_pct, b.marketplace_avg_budget_amount,
            CASE WHEN p.impressions >= 20 AND p.ctr_pct < COALESCE(b.marketplace_ctr_pct, p.ctr_pct)
                    THEN 'Improve conversion'
                WHEN p.impressions < 10 AND p.ctr_pct >= COALESCE(b.marketplace_ctr_pct, p.ctr_pct)
                    THEN 'Increase visibility'
                WHEN p.budget_amount < COALESCE(b.marketplace_avg_budget_amount, p.budget_amount)
                    THEN 'Review budget competitiveness'
                ELSE 'Monitor' END AS opportunity_type, p.recommended_action
        FROM client_posting_performance p LEFT JOIN client_category_benchmark b
            ON p.client_uid = b.client_uid AND p.category = b.category
        WHERE p.is_active""",
    # the funnel with all dimensions of the metric view
    "wide_funnel": """
        SELECT f.*, fr.name, fr.country, fr.primary_skill, fr.top_rated, j.title, j.category, j.client_uid,
            c.company_name, c.industry, c.numeric_total_spend_usd
        FROM s_fact_search_funnel f LEFT JOIN freelancers fr ON f.visitor_id = fr.visitor_id
        LEFT JOIN jobs j ON f.opening_uid = j.opening_uid LEFT JOIN clients c ON j.client_uid = c.client_uid""",
    "visitor_counts": f"""
        SELECT f.visitor_id, top_rated, numeric_hourly_rate, event_id, was_clicked, time_to_click_secs
        FROM fact_search_events f LEFT JOIN dim_freelancer d ON f.visitor_id = d.visitor_id""",
    "documented_clicks": r"""
        SELECT * REPLACE (TRY_CAST(NULLIF(regexp_extract(time_to_click_secs, '^\s*([+-]?[0-9]+(?:\.[0-9]+)?)\s*$', 1), '')
            AS DOUBLE) AS time_to_click_secs, is_bot = 'True' AS is_bot) FROM raw_clicks""",
}

_MARTS = [name for name in CTES if name.startswith(("p_", "s_"))]
_STAR = ["dim_job", "dim_client", "dim_category", "dim_freelancer", "dim_date", "dim_search", "fact_search_events"]
_REPORTS = ["client_posting_performance", "client_category_benchmark", "client_opportunities"]


def with_ctes(select: str) -> str:
    """Put the needed definitions, in order, in front of a SELECT."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in CTES and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(select)
    parts = [f"{name} AS ({body})" for name, body in CTES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def _text(columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns.split())


_IMPRESSION_TEXT = _text("event_id visitor_id search_guid opening_uid position")
_NO_RESCUE = "CAST(NULL AS VARCHAR) AS _rescued_data"
_BRONZE = {
    "bronze_search_events": f"SELECT {_text('search_guid visitor_id')}, search_query, sublocation, sort, page, event_ts, "
    f"{_NO_RESCUE} FROM raw_searches",
    "bronze_impression_events": f"SELECT {_IMPRESSION_TEXT}, event_ts, collector_ts, is_bot, {_NO_RESCUE} "
    "FROM raw_impressions",
    "bronze_click_events": f"SELECT {_IMPRESSION_TEXT}, event_ts, collector_ts, is_bot, time_to_click_secs, "
    f"{_NO_RESCUE} FROM raw_clicks",
    "bronze_job_openings": f"SELECT {_text('opening_uid client_uid')}, title, category, budget_type, budget_amount, "
    f"CAST(posted_at AS TIMESTAMP) AS posted_at, is_active, {_NO_RESCUE} FROM raw_jobs",
    "bronze_clients": f"SELECT {_text('client_uid')}, company_name, country, industry, payment_verified, "
    f"total_spend_usd, member_since, avg_rating, {_NO_RESCUE} FROM raw_clients",
    "bronze_freelancers": f"SELECT {_text('visitor_id')}, name, country, primary_skill, hourly_rate, "
    f"job_success_score, member_since, top_rated, is_verified, {_NO_RESCUE} FROM raw_freelancers",
}

_INGESTION = {
    "csv_batch_scan": f"SELECT {_IMPRESSION_TEXT}, event_ts, collector_ts, is_bot, time_to_click_secs FROM raw_clicks",
    "csv_root_setting": f"SELECT {_IMPRESSION_TEXT}, event_ts, collector_ts, is_bot, time_to_click_secs FROM raw_clicks",
    "csv_inferred_read": "SELECT CAST(visitor_id AS INT) AS visitor_id, name, country, primary_skill, hourly_rate, "
    "job_success_score, member_since, top_rated, is_verified FROM raw_freelancers",
    "csv_reordered_columns": f"SELECT {_text('client_uid')}, company_name, country, industry, payment_verified, "
    "total_spend_usd, member_since, avg_rating, CASE WHEN client_uid % 2 <> 0 THEN "
    "'{\"region\":\"region ' || (client_uid % 3) || '\"}' END AS _rescued_data FROM raw_clients",
    "rescued_values": "SELECT CAST(opening_uid AS VARCHAR) AS opening_uid, TRY_CAST(budget_amount AS DOUBLE) "
    "AS budget_amount, CASE WHEN TRY_CAST(budget_amount AS DOUBLE) IS NULL THEN "
    "'{\"budget_amount\":\"' || budget_amount || '\"}' END AS _rescued_data FROM raw_jobs",
    "source_lineage": "SELECT COUNT(*) AS rows, COUNT(*) AS rows_with_file, COUNT(*) AS rows_with_time FROM raw_searches",
    "incremental_files": "SELECT sublocation, COUNT(search_guid) AS searches FROM raw_searches GROUP BY 1",
    "streamed_silver_search_events": f"SELECT * REPLACE ({_text('search_guid visitor_id')}) FROM searches",
    "streamed_silver_impression_events": "SELECT * REPLACE "
    f"({_text('visitor_id search_guid opening_uid')}) FROM impressions",
    "streamed_silver_click_events": f"SELECT * REPLACE ({_text('visitor_id search_guid opening_uid')}) FROM clicks",
    "streamed_quarantine_impressions": "SELECT * REPLACE "
    f"({_text('visitor_id search_guid opening_uid')}) FROM typed_impressions WHERE is_bot",
    "streamed_event_log": f"SELECT flow AS table_name, rule AS expectation, {total('passed')} AS passed_records, "
    f"{total('failed')} AS failed_records, {total('passed + failed')} AS total_records, "
    f"{pct('SUM(passed)', 'SUM(passed + failed)')} AS pass_rate_pct "
    "FROM rule_log WHERE flow <> 'silver.impression_events' GROUP BY 1, 2",
    "streamed_click_dedup": "SELECT event_id, CAST(search_guid AS VARCHAR) AS search_guid, event_ts, time_to_click_secs "
    "FROM raw_clicks QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_ts) = 1",
}

_SILVER = {
    "silver_search_events": "SELECT * FROM searches",
    "silver_impression_events": "SELECT * FROM impressions",
    "silver_click_events": "SELECT * FROM clicks",
    "silver_freelancers": "SELECT * FROM freelancers",
    "silver_clients": "SELECT * FROM clients",
    "silver_job_openings": "SELECT * FROM jobs",
}

_LATEST_ORDER = (
    "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
)


def _rule_counts(flow: str) -> str:
    return (
        f"SELECT rule AS expectation, {total('passed')} AS passed_records, {total('failed')} AS failed_records "
        f"FROM rule_log WHERE flow = 'silver.{flow}' GROUP BY 1"
    )


def _mart_rule(rule: str, holds: str, mart: str) -> str:
    ok = f"COALESCE({holds}, false)"
    return (
        f"SELECT '{rule}' AS expectation, {iff(ok)} AS passed_records, {iff(f'NOT {ok}')} AS failed_records FROM {mart}"
    )


def _documented_counts() -> str:
    seconds, score, budget = "time_to_click_secs", "TRY_CAST(job_success_score AS DOUBLE)", "TRY_CAST(budget_amount AS DOUBLE)"
    rules = [
        ("search_events", "raw_searches", "valid_search_guid", "search_guid IS NOT NULL"),
        ("search_events", "raw_searches", "valid_visitor_id", "visitor_id IS NOT NULL"),
        ("search_events", "raw_searches", "known_sublocation", "sublocation IN ('search_results', 'featured_jobs')"),
        ("search_events", "raw_searches", "known_sort", "sort IN ('recency', 'relevance')"),
        ("search_events", "raw_searches", "not_future_event", f"event_ts <= TIMESTAMP '{AS_OF}'"),
        ("impression_events", "raw_impressions", "valid_event_id", "event_id IS NOT NULL"),
        ("impression_events", "raw_impressions", "no_bots", "is_bot = 'False'"),
        ("click_events", "documented_clicks", "valid_event_id", "event_id IS NOT NULL"),
        ("click_events", "documented_clicks", "no_bots", "NOT is_bot"),
        ("click_events", "documented_clicks", "not_negative_time", f"{seconds} >= 0 OR {seconds} IS NULL"),
        ("click_events", "documented_clicks", "not_future_event", f"event_ts <= TIMESTAMP '{AS_OF}'"),
        ("job_openings", "raw_jobs", "valid_title", "title IS NOT NULL"),
        ("job_openings", "raw_jobs", "not_negative_budget", f"{budget} >= 0 OR {budget} IS NULL"),
        ("job_openings", "raw_jobs", "not_future_post", f"posted_at <= TIMESTAMP '{AS_OF}'"),
        ("clients", "raw_clients", "not_future_member", f"member_since <= DATE '{AS_OF[:10]}'"),
        ("freelancers", "raw_freelancers", "not_negative_score", f"{score} >= 0 OR {score} IS NULL"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{data}' AS dataset, * FROM ({_mart_rule(rule, f'({holds})', table)})" for data, table, rule, holds in rules
    )


_REASON = (
    "CASE WHEN is_bot THEN 'bot_traffic' WHEN event_id IS NULL THEN 'null_event_id' "
    "WHEN position IS NULL THEN 'invalid_position' WHEN visitor_id IS NULL THEN 'valid_visitor_id' "
    "WHEN search_guid IS NULL THEN 'valid_search_guid' WHEN opening_uid IS NULL THEN 'valid_opening_uid' "
    "WHEN time_to_click_secs IS NULL THEN 'valid_time_to_click_secs' END"
)
_REJECTED_CLICK = (
    "(visitor_id IS NULL OR search_guid IS NULL OR opening_uid IS NULL OR position IS NULL "
    "OR time_to_click_secs IS NULL OR is_bot)"
)

_BREAKDOWN = (
    f"SELECT flow AS table_name, rule AS expectation, {total('passed')} AS passed_records, "
    f"{total('failed')} AS failed_records, {total('passed + failed')} AS total_records, "
    f"{pct('SUM(passed)', 'SUM(passed + failed)')} AS pass_rate_pct FROM rule_log GROUP BY 1, 2"
)

_QUALITY = {
    "expect_counts_search_events": _rule_counts("search_events"),
    "expect_counts_impression_events": _rule_counts("impression_events"),
    "expect_counts_click_events": _rule_counts("click_events"),
    "expect_warn_job_mart": _mart_rule(
        "clicks_le_impressions", "(clicks <= impressions OR clicks IS NULL)", "p_job_performance"
    ),
    "expect_warn_daily_mart": _mart_rule(
        "positive_ctr", "(ctr_pct IS NULL OR ctr_pct BETWEEN 0 AND 100)", "p_daily_metrics"
    ),
    "expect_or_fail_searches": "SELECT * FROM raw_searches",
    "documented_rule_counts": _documented_counts(),
    "documented_click_events": "SELECT * FROM documented_clicks WHERE event_id IS NOT NULL AND NOT is_bot "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_ts, visitor_id, opening_uid, time_to_click_secs) = 1",
    "documented_numbers": "SELECT visitor_id, hourly_rate, TRY_CAST(hourly_rate AS DOUBLE) AS numeric_hourly_rate, "
    "job_success_score, TRY_CAST(job_success_score AS DOUBLE) AS numeric_job_success_score FROM raw_freelancers",
    "quarantine_impression_events": "SELECT * FROM typed_impressions WHERE is_bot",
    "quarantine_click_events": f"SELECT *, {_REASON} AS quarantine_reason FROM typed_clicks WHERE {_REJECTED_CLICK}",
    "quarantine_balance": "SELECT 'click_events' AS dataset, (SELECT COUNT(*) FROM raw_clicks) AS bronze, "
    "(SELECT COUNT(*) FROM clicks) AS silver, (SELECT COUNT(*) FROM raw_clicks) - (SELECT COUNT(*) FROM clicks) AS quarantined "
    "UNION ALL SELECT 'impression_events', (SELECT COUNT(*) FROM raw_impressions), (SELECT COUNT(*) FROM impressions), "
    "(SELECT COUNT(*) FROM raw_impressions) - (SELECT COUNT(*) FROM impressions)",
    "quarantine_rejected_searches": "SELECT * FROM raw_searches WHERE visitor_id IS NULL OR search_guid IS NULL "
    "OR sublocation NOT IN ('search_results', 'featured_jobs')",
    "quarantine_reasons_impression_events": "SELECT CASE WHEN visitor_id IS NULL THEN 'valid_visitor_id' "
    "ELSE 'valid_visitors' END AS quarantine_reason, COUNT(*) AS rows FROM typed_impressions "
    "WHERE visitor_id IS NULL OR is_bot GROUP BY 1",
    "quality_event_log": "SELECT l.run AS timestamp, 'flow_progress' AS event_type, l.flow AS flow_name, "
    "'{\"flow_progress\":{\"metrics\":{\"num_output_rows\":' || l.passed || '},\"data_quality\":{\"dropped_records\":' "
    "|| l.dropped || ',\"expectations\":[' || r.items || ']}}}' AS details FROM flow_log l JOIN "
    "(SELECT run, flow, string_agg('{\"name\":\"' || rule || '\",\"dataset\":\"' || flow || '\",\"passed_records\":' || "
    "passed || ',\"failed_records\":' || failed || '}', ',' ORDER BY ord) AS items FROM rule_log GROUP BY 1, 2) r "
    "ON l.run = r.run AND l.flow = r.flow",
    "dq_rows_processed_vs_dropped": f"SELECT flow AS table_name, {total('passed')} AS rows_passed, "
    f"{total('dropped')} AS rows_dropped, {pct('SUM(dropped)', 'SUM(passed + dropped)')} AS drop_rate_pct "
    "FROM flow_log GROUP BY 1",
    "dq_expectation_breakdown": _BREAKDOWN,
    "dq_top_failing_expectations": f"SELECT rule AS expectation, flow AS table_name, {total('failed')} AS total_failures "
    "FROM rule_log WHERE failed > 0 GROUP BY 1, 2",
    "dq_drop_rate_trend": f"SELECT run AS run_hour, flow AS table_name, {total('passed')} AS rows_passed, "
    f"{total('dropped')} AS rows_dropped FROM flow_log GROUP BY 1, 2",
    "dq_expectation_event_log": "SELECT run AS timestamp, flow AS table_name, rule AS expectation, "
    "passed AS passed_records, failed AS failed_records FROM rule_log "
    "ORDER BY run DESC, failed DESC, flow, rule LIMIT 200",
    "dq_widget_rows_by_table": f"SELECT flow AS table_name, {total('passed')} AS rows_passed, "
    f"{total('dropped')} AS rows_dropped FROM flow_log GROUP BY 1",
    "dq_widget_failures_by_rule": f"SELECT rule AS expectation, {total('failed')} AS total_failures "
    "FROM rule_log WHERE failed > 0 GROUP BY 1",
    "dq_widget_pass_fail_by_rule": f"SELECT rule AS expectation, {total('passed')} AS passed_records, "
    f"{total('failed')} AS failed_records FROM rule_log GROUP BY 1",
    "dq_widget_dropped_by_hour": f"SELECT run AS run_hour, flow AS table_name, {total('dropped')} AS rows_dropped "
    "FROM flow_log GROUP BY 1, 2",
    "named_parameter_query": f"SELECT flow AS table_name, {total('passed')} AS rows_passed, "
    f"{total('dropped')} AS rows_dropped FROM flow_log WHERE flow = 'silver.click_events' GROUP BY 1",
}

_TABLES = {
    "materialized_mart": "SELECT * FROM p_position_ctr",
    "published_table": "SELECT * FROM dim_category",
    "persistent_view": "SELECT client_uid, company_name, opening_uid, title, impressions, clicks "
    "FROM client_posting_performance WHERE is_active",
    "sql_view": f"SELECT opportunity_segment, COUNT(*) AS postings, {total('impressions')} AS impressions "
    "FROM client_posting_performance GROUP BY 1",
    "medallion_job_performance": f"SELECT * REPLACE ({_text('opening_uid client_uid')}, "
    "CAST(posted_at AS TIMESTAMP) AS posted_at) FROM p_job_performance",
    "client_picker": "SELECT client_uid, company_name FROM clients",
}

_RATIO = "CAST(COUNT(click_id) AS DOUBLE) / NULLIF(COUNT(impression_id), 0)"
_MEASURES = f"COUNT(impression_id) AS total_impressions, {_RATIO} AS CTR"
_FUNNEL_MEASURES = (
    "COUNT(impression_id) AS impressions, COUNT(click_id) AS clicks, "
    f"{pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct"
)
_FUNNEL_TIME = f"{rnd('AVG(time_to_click_secs)', 1)} AS avg_time_to_click_secs"
_PORTFOLIO = (
    f"COUNT(DISTINCT client_uid) AS clients_tracked, COUNT(opening_uid) AS jobs_posted, {iff('is_active')} AS active_jobs, "
    f"{total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks, "
    f"{pct('SUM(clicks)', 'SUM(impressions)')} AS ctr_pct, {rnd('AVG(budget_amount)', 2)} AS avg_budget_amount, "
    "COUNT(DISTINCT category) AS unique_categories"
)
_CATEGORY = (
    f"SELECT category, {total('impressions')} AS impressions, {total('clicks')} AS clicks, "
    f"{pct('SUM(clicks)', 'SUM(impressions)')} AS ctr_pct, {ratio('SUM(clicks)', 'SUM(impressions)')} AS ctr, "
    f"{rnd('AVG(budget_amount)', 2)} AS avg_budget_amount FROM client_posting_performance GROUP BY 1"
)

_METRICS = {
    "mv_clickstream_by_country_and_skill": f"SELECT country, primary_skill, {_MEASURES} FROM wide_funnel GROUP BY 1, 2",
    "mv_clickstream_by_industry": f"SELECT industry, category, {_MEASURES} FROM wide_funnel GROUP BY 1, 2",
    "mv_clickstream_overall": f"SELECT {_MEASURES} FROM wide_funnel",
    "mv_clickstream_featured_by_position": f"SELECT position, {_MEASURES} FROM wide_funnel "
    "WHERE sublocation = 'featured_jobs' GROUP BY 1",
    "mv_clickstream_key_check": "SELECT * FROM (SELECT 'freelancers' AS join_name, CAST(visitor_id AS VARCHAR) AS key, "
    "COUNT(*) AS count FROM freelancers GROUP BY 2 UNION ALL SELECT 'job_openings', CAST(opening_uid AS VARCHAR), COUNT(*) "
    "FROM jobs GROUP BY 2 UNION ALL SELECT 'job_openings__clients', CAST(client_uid AS VARCHAR), COUNT(*) FROM clients "
    "GROUP BY 2) WHERE count > 1",
    "mv_client_portfolio": f"SELECT company_name, {_PORTFOLIO} FROM client_posting_performance GROUP BY 1",
    "mv_category_performance": _CATEGORY,
    "mv_search_funnel": "SELECT search_query, sublocation, COUNT(DISTINCT search_guid) AS searches, "
    "COUNT(DISTINCT CASE WHEN click_id IS NOT NULL THEN search_guid END) AS searches_with_clicks, "
    f"{_FUNNEL_MEASURES}, {_FUNNEL_TIME} FROM s_fact_search_funnel GROUP BY 1, 2",
    "mv_search_funnel_by_date": "SELECT CAST(search_ts AS DATE) AS search_date, COUNT(DISTINCT search_guid) AS searches, "
    f"{_FUNNEL_MEASURES} FROM s_fact_search_funnel GROUP BY 1",
    "mv_from_yaml": "SELECT sublocation AS placement, position AS search_page_position, COUNT(impression_id) AS shown, "
    "COUNT(click_id) AS clicked, ROUND(COUNT(click_id) / NULLIF(COUNT(impression_id), 0), 4) AS click_share "
    "FROM s_fact_search_funnel GROUP BY 1, 2",
    "mv_position_bias": f"SELECT position, {_FUNNEL_MEASURES}, {_FUNNEL_TIME} FROM s_fact_search_funnel GROUP BY 1",
}

_JOB_BOARD = "SELECT p.opening_uid, p.title, j.category, j.budget_type, j.numeric_budget_amount, p.impressions, p.clicks, p.ctr_pct"
_LATENCY = (
    "CASE WHEN time_to_click_secs IS NULL THEN 'unknown' WHEN time_to_click_secs < 3 THEN '< 3s (instant)' "
    "WHEN time_to_click_secs < 10 THEN '3-10s' WHEN time_to_click_secs < 30 THEN '10-30s' "
    "WHEN time_to_click_secs < 60 THEN '30-60s' ELSE '> 60s' END"
)
_OVERALL = pct("SUM(p.clicks)", "SUM(p.impressions)")

_DASHBOARDS = {
    "ins_funnel_summary": f"SELECT {total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks, "
    f"{pct('SUM(clicks)', 'SUM(impressions)')} AS overall_ctr_pct, COUNT(DISTINCT opening_uid) AS jobs_in_results "
    "FROM s_job_performance_ctr",
    "ins_top_jobs_by_impressions": f"{_JOB_BOARD}, p.avg_impression_position, p.avg_click_time "
    "FROM s_job_performance_ctr p LEFT JOIN jobs j ON p.opening_uid = j.opening_uid WHERE p.impressions IS NOT NULL "
    "ORDER BY p.impressions DESC, p.opening_uid LIMIT 10",
    "ins_top_jobs_by_ctr": f"{_JOB_BOARD}, p.avg_impression_position FROM s_job_performance_ctr p "
    "LEFT JOIN jobs j ON p.opening_uid = j.opening_uid WHERE p.impressions >= 5 "
    "ORDER BY p.ctr_pct DESC, p.opening_uid LIMIT 10",
    "ins_position_bias": "SELECT page_position, impressions, avg_click_time FROM s_impression_position_ctr "
    "WHERE page_position <= 20",
    "ins_category_performance": f"SELECT category, job_count, active_jobs, {rnd('avg_budget', 0)} AS avg_budget, "
    "impressions, unique_visitors, clicks, ctr_pct FROM s_category_performance WHERE category IS NOT NULL",
    "ins_category_ctr_vs_budget": f"SELECT category, {rnd('avg_budget', 0)} AS avg_budget, ctr_pct, impressions "
    "FROM s_category_performance WHERE category IS NOT NULL AND avg_budget IS NOT NULL",
    "ins_search_query_performance": "SELECT * FROM s_search_query_performance "
    "ORDER BY impressions DESC, search_query LIMIT 20",
    "ins_sublocation_performance": "SELECT * FROM s_sublocation_performance",
    "ins_daily_trend": "SELECT * FROM s_daily_metrics",
    "ins_time_to_click": f"SELECT {_LATENCY} AS latency_bucket, COUNT(*) AS clicks, "
    f"{rnd('AVG(time_to_click_secs)', 1)} AS avg_secs FROM clicks GROUP BY 1",
    "ins_budget_type_distribution": "SELECT j.budget_type, COUNT(*) AS job_count, "
    f"{rnd('AVG(j.numeric_budget_amount)', 2)} AS avg_budget_amount, {total('p.impressions')} AS total_impressions, "
    f"{_OVERALL} AS ctr_pct FROM jobs j LEFT JOIN s_job_performance_ctr p ON j.opening_uid = p.opening_uid "
    "WHERE j.budget_type IS NOT NULL GROUP BY 1",
    "ins_client_activity": "SELECT j.client_uid, COUNT(DISTINCT j.opening_uid) AS jobs_posted, "
    f"{total('p.impressions')} AS total_impressions, {total('p.clicks')} AS total_clicks, {_OVERALL} AS avg_ctr_pct, "
    f"{rnd('AVG(j.numeric_budget_amount)', 2)} AS avg_budget_amount FROM jobs j "
    "LEFT JOIN s_job_performance_ctr p ON j.opening_uid = p.opening_uid GROUP BY 1 "
    "ORDER BY total_impressions DESC NULLS LAST, j.client_uid LIMIT 15",
    "cli_portfolio_overview": "SELECT clients_tracked, jobs_posted AS total_jobs_posted, total_impressions, "
    f"ctr_pct AS avg_ctr_pct FROM (SELECT {_PORTFOLIO} FROM client_posting_performance)",
    "cli_top_accounts": "SELECT company_name, active_jobs, total_impressions, total_clicks, ctr_pct, avg_budget_amount, "
    f"unique_categories FROM (SELECT company_name, {_PORTFOLIO} FROM client_posting_performance GROUP BY 1) "
    "ORDER BY total_impressions DESC, company_name LIMIT 15",
    "cli_posting_watchlist": "SELECT opening_uid, company_name, title, category, impressions, clicks, ctr_pct, "
    "opportunity_segment, recommended_action FROM client_posting_performance WHERE is_active "
    "ORDER BY impressions DESC, ctr_pct, opening_uid LIMIT 20",
    "cli_category_benchmark": "SELECT client_uid, company_name, category, client_active_jobs, client_impressions, "
    "client_ctr_pct, marketplace_ctr_pct, ctr_gap_pct, client_avg_budget_amount, marketplace_avg_budget_amount, "
    "budget_gap_amount FROM client_category_benchmark WHERE client_impressions IS NOT NULL "
    "ORDER BY ABS(ctr_gap_pct) DESC NULLS LAST, client_uid, category LIMIT 20",
    "cli_opportunities": "SELECT opening_uid, company_name, title, category, impressions, ctr_pct, opportunity_type, "
    "recommended_action FROM client_opportunities ORDER BY impressions DESC, ctr_pct, opening_uid LIMIT 20",
    "cli_marketplace_snapshot": f"SELECT category, impressions, clicks, ctr_pct, avg_budget_amount FROM ({_CATEGORY}) "
    "ORDER BY impressions DESC, category LIMIT 15",
}


def _ctr_by(dimension: str) -> str:
    return (
        f"SELECT {dimension}, COUNT(impression_id) AS total_impressions, {rnd(_RATIO, 6)} AS CTR "
        "FROM wide_funnel GROUP BY 1"
    )


def _behaviour(by: str, name: str) -> str:
    return (
        f"SELECT {by} AS {name}, COUNT(DISTINCT visitor_id) AS visitors, COUNT(event_id) AS impressions, "
        f"{pct('SUM(CASE WHEN was_clicked THEN 1 ELSE 0 END)', 'COUNT(event_id)')} AS ctr_pct, "
        f"{rnd('AVG(time_to_click_secs)', 2)} AS avg_time_to_click_secs FROM visitor_counts GROUP BY 1"
    )


_SPEND = (
    f"SELECT client_uid, company_name, numeric_total_spend_usd, {_RATIO} AS CTR FROM wide_funnel GROUP BY 1, 2, 3"
)

_QUESTIONS = {
    "q_week_traffic": "SELECT COUNT(impression_id) AS impressions, COUNT(click_id) AS clicks FROM s_fact_search_funnel "
    f"WHERE search_ts >= DATE '{WEEK_START}' AND search_ts < DATE '{WEEK_START}' + 7",
    "q_overall_ctr": f"SELECT {pct('SUM(clicks)', 'SUM(impressions)')} AS overall_ctr_pct FROM s_job_performance_ctr",
    "q_recent_days": "SELECT event_date, impressions, clicks, ctr_pct FROM s_daily_metrics "
    f"WHERE event_date > DATE '{LAST_DAY}' - 30 AND event_date <= DATE '{LAST_DAY}'",
    "q_busiest_hour": "SELECT * FROM s_hourly_activity ORDER BY impressions DESC, hour_of_day LIMIT 1",
    "q_jobs_by_impressions": "SELECT opening_uid, title, impressions FROM s_job_performance_ctr "
    "WHERE opening_uid IS NOT NULL ORDER BY impressions DESC, opening_uid LIMIT 10",
    "q_jobs_by_ctr": "SELECT opening_uid, title, ctr_pct FROM s_job_performance_ctr WHERE opening_uid IS NOT NULL "
    "AND impressions >= 5 "
    "ORDER BY ctr_pct DESC NULLS LAST, opening_uid LIMIT 10",
    "q_jobs_at_top": "SELECT i.opening_uid, title, COUNT(event_id) AS top_impressions FROM impressions i "
    "LEFT JOIN jobs j ON i.opening_uid = j.opening_uid WHERE position <= 3 GROUP BY 1, 2 "
    "ORDER BY top_impressions DESC, i.opening_uid LIMIT 10",
    "q_seen_but_not_clicked": "SELECT opening_uid, title, impressions, clicks, ctr_pct FROM client_posting_performance "
    f"WHERE impressions >= {LEAST_SEEN} AND ctr_pct < {LOW_CTR}",
    "q_queries_by_clicks": "SELECT search_query, clicks, impressions FROM s_search_query_performance",
    "q_queries_without_clicks": "SELECT search_query, search_sessions FROM s_search_query_performance "
    f"WHERE clicks <= {FEW_CLICKS} * (SELECT SUM(clicks) FROM s_search_query_performance)",
    "q_queries_by_ctr": "SELECT search_query, ctr_pct FROM s_search_query_performance",
    "q_categories_by_ctr": "SELECT category, ctr_pct FROM s_category_performance",
    "q_budget_by_category": "SELECT category, avg_budget_amount FROM dim_category",
    "q_impressions_per_active_job": f"SELECT category, {rnd(ratio('impressions', 'active_jobs'), 2)} "
    "AS impressions_per_active_job FROM s_category_performance",
    "q_featured_vs_organic_ctr": "SELECT sublocation, ctr_pct FROM s_sublocation_performance",
    "q_position_by_placement": "SELECT sublocation, avg_position FROM s_sublocation_performance",
    "q_featured_click_speed": f"SELECT f AS featured_jobs, o AS search_results, {rnd('o - f', 1)} AS featured_faster_secs "
    "FROM (SELECT MAX(CASE WHEN sublocation = 'featured_jobs' THEN avg_click_time END) AS f, "
    "MAX(CASE WHEN sublocation = 'search_results' THEN avg_click_time END) AS o FROM s_sublocation_performance)",
    "q_ctr_by_position": "SELECT page_position, ctr_pct FROM s_impression_position_ctr",
    "q_click_time_at_positions": "SELECT page_position, avg_click_time FROM s_impression_position_ctr "
    "WHERE page_position IN (1, 7)",
    "q_clients_by_ctr": _ctr_by("company_name"),
    "q_clients_by_jobs_shown": "SELECT company_name, COUNT(DISTINCT opening_uid) AS jobs_shown FROM wide_funnel "
    "WHERE impression_id IS NOT NULL GROUP BY 1 ORDER BY jobs_shown DESC, company_name LIMIT 15",
    "q_ctr_spread_in_category": "SELECT category, COUNT(client_ctr_pct) AS clients, MIN(client_ctr_pct) AS lowest_ctr_pct, "
    f"MAX(client_ctr_pct) AS highest_ctr_pct, {rnd('MAX(client_ctr_pct) - MIN(client_ctr_pct)', 2)} AS spread_pct "
    "FROM client_category_benchmark GROUP BY 1",
    "q_client_spend_vs_ctr": f"SELECT client_uid, company_name, numeric_total_spend_usd, {rnd('CTR', 6)} AS CTR "
    f"FROM ({_SPEND}) WHERE numeric_total_spend_usd IS NOT NULL ORDER BY numeric_total_spend_usd DESC, client_uid LIMIT 15",
    "q_spend_ctr_correlation": f"SELECT {rnd('CORR(numeric_total_spend_usd, CTR)', 6)} AS correlation FROM ({_SPEND})",
    "q_ctr_by_country": _ctr_by("country"),
    "q_ctr_by_top_rated": _ctr_by("top_rated"),
    "q_ctr_by_skill": _ctr_by("primary_skill"),
    "q_clients_at_risk": "SELECT client_uid, company_name, total_impressions, total_clicks, ctr_pct FROM "
    f"(SELECT client_uid, company_name, {total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks, "
    f"{pct('SUM(clicks)', 'SUM(impressions)')} AS ctr_pct FROM client_posting_performance GROUP BY 1, 2) "
    f"WHERE total_impressions > 0 AND (ctr_pct < {LOW_CTR} OR total_clicks = 0)",
    "q_demand_against_posting_mix": "SELECT category, impressions, client_jobs, demand_pct, posting_pct, "
    f"{rnd('COALESCE(demand_pct, 0) - COALESCE(posting_pct, 0)', 2)} AS mismatch_pct FROM ("
    f"SELECT category, impressions, client_jobs, {pct('impressions', 'SUM(impressions) OVER ()')} AS demand_pct, "
    f"{pct('client_jobs', 'SUM(client_jobs) OVER ()')} AS posting_pct FROM (SELECT category, {total('impressions')} "
    f"AS impressions, {iff(f'client_uid = {CLIENT}')} AS client_jobs FROM client_posting_performance GROUP BY 1))",
    "q_weakest_jobs_of_client": "SELECT opening_uid, title, category, ctr_pct, marketplace_ctr_pct, "
    f"{rnd('ctr_pct - marketplace_ctr_pct', 2)} AS gap_pct, opportunity_type, recommended_action "
    f"FROM client_opportunities WHERE client_uid = {CLIENT}",
    "q_gaps_of_client": "SELECT category, client_ctr_pct, marketplace_ctr_pct, ctr_gap_pct, client_avg_budget_amount, "
    f"marketplace_avg_budget_amount, budget_gap_amount FROM client_category_benchmark WHERE client_uid = {CLIENT}",
    "q_click_speed_of_top_rated": _behaviour("top_rated", "top_rated"),
    "q_behaviour_by_hourly_rate": _behaviour("CAST(FLOOR(numeric_hourly_rate / 10) * 10 AS INT)", "rate_from"),
}

_MASK = "sha256(CAST(visitor_id AS VARCHAR)) AS visitor_id"
_GOVERNANCE = {
    "sql_governance_functions": "SELECT opening_uid, client_uid, sha256(CAST(opening_uid AS VARCHAR)) AS masked "
    f"FROM dim_job WHERE client_uid = {CLIENT}",
    "gov_masked_clicks": f"SELECT event_id, {_MASK}, opening_uid FROM clicks",
    "gov_clear_clicks": f"SELECT event_id, {_text('visitor_id')}, opening_uid FROM clicks",
    "gov_masked_peek_in_order": f"SELECT {_MASK} FROM clicks ORDER BY event_id LIMIT 5",
    "gov_masked_fact": f"SELECT * REPLACE ({_MASK}) FROM fact_search_events",
    "gov_own_jobs": f"SELECT * FROM dim_job WHERE client_uid = {CLIENT}",
    "gov_all_jobs": "SELECT * FROM dim_job",
    "gov_recent_access": "SELECT event_time, user_email, action_name, table_name FROM audit_log "
    "WHERE action_name IN ('SELECT', 'CREATE TABLE', 'ALTER TABLE', 'GRANT') AND table_name LIKE 'market.%' "
    "ORDER BY event_time DESC, event_id LIMIT 50",
    "gov_column_lineage": "SELECT concat('market.silver.', event_type) AS source_table_full_name, "
    "concat('col_', user_id % 7) AS source_column_name, concat('market.gold.table_', user_id % 20) "
    "AS target_table_full_name, concat('col_', event_id % 11) AS target_column_name FROM events "
    "WHERE concat('market.gold.table_', user_id % 20) = 'market.gold.table_7'",
    "gov_masked_distinct_visitors": "SELECT COUNT(DISTINCT visitor_id) AS visitors FROM clicks",
}

_OPERATORS = {
    "lenient_casts": "SELECT event_id, TRY_CAST(time_to_click_secs AS DOUBLE) AS seconds, "
    "TRY_CAST(time_to_click_secs AS INT) AS whole_seconds, TRY_CAST(time_to_click_secs AS DOUBLE) AS seconds_by_pattern, "
    "is_bot = 'True' AS is_bot FROM raw_clicks",
    "latency_labels": f"SELECT event_id, {_LATENCY} AS latency_bucket FROM clicks",
    "first_click_per_search_and_job": "SELECT * FROM first_clicks",
    "distinct_search_attributes": "SELECT DISTINCT search_query, sublocation FROM searches",
    "impressions_with_search": "SELECT i.event_id, i.search_guid, s.search_query, s.sublocation FROM impressions i "
    "LEFT JOIN searches s ON i.search_guid = s.search_guid",
    "click_rate_of_pairs": "SELECT search_guid, opening_uid, COUNT(*) AS rows, COUNT(impression_id) AS impressions, "
    f"COUNT(click_id) AS clicks, {pct('COUNT(click_id)', 'COUNT(impression_id)')} AS ctr_pct FROM s_fact_search_funnel "
    "WHERE opening_uid IS NOT NULL GROUP BY 1, 2",
}


# The group of each mart with distinct counts.
_GROUPS = {
    "s_job_performance_ctr": "opening_uid",
    "s_search_query_performance": "search_query",
    "s_category_performance": "category",
    "s_sublocation_performance": "sublocation",
    "s_daily_metrics": "event_date",
    "s_visitor_engagement": "visitor_id",
    "s_job_click_engagement": "opening_uid",
    "s_hourly_activity": "hour_of_day",
}
_APPROXIMATIONS = {
    f"{mart}_approx_error": f'SELECT CAST({key} AS VARCHAR) AS "group", true AS within_bound FROM {mart}'
    for mart, key in _GROUPS.items()
}

_STORED = {
    "medallion_s_job_performance_ctr": f"SELECT * REPLACE ({_text('opening_uid client_uid')}) FROM s_job_performance_ctr",
    "medallion_s_daily_metrics": "SELECT * FROM s_daily_metrics",
    "medallion_s_sublocation_performance": "SELECT * FROM s_sublocation_performance",
    "incremental_fact_search_events": f"SELECT * REPLACE ({_text('opening_uid visitor_id search_guid')}) FROM fact_search_events",
    "medallion_fact_search_events": f"SELECT * REPLACE ({_text('opening_uid visitor_id search_guid')}) FROM fact_search_events",
    "medallion_client_opportunities": f"SELECT * REPLACE ({_text('client_uid opening_uid')}) FROM client_opportunities",
}


def oracle_sql() -> dict[str, str]:
    plain = {name: f"SELECT * FROM {name}" for name in [*_MARTS, *_STAR, *_REPORTS, "distinct_by_period"]}
    feeds = {"scd1_customer_orders": _LATEST_ORDER, "scd1_customer_orders_stream": _LATEST_ORDER}
    groups = [
        plain, feeds, _BRONZE, _INGESTION, _SILVER, _QUALITY, _TABLES, _METRICS, _DASHBOARDS, _QUESTIONS,
        _GOVERNANCE, _OPERATORS, _APPROXIMATIONS, _STORED,
    ]
    return {name: with_ctes(select) for group in groups for name, select in group.items()}

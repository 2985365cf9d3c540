"""The registered queries in SQL, written against the given tables only.

``FRAGMENTS`` holds common table expressions; a query gets those it refers to,
directly or through others. Rates are rounded half up from the decimal text of
the double, as Spark does; rounding its binary value would turn 16.525 into 16.52.
"""

from __future__ import annotations

import re

FRAGMENTS = {
    "ev": """
        SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type, value,
               json_extract_string(props, '$.k') AS k,
               'm' || json_extract_string(props, '$.k') AS media_id
        FROM events""",
    "lags": "SELECT unnest([0, 1]) AS lag",
    "all_runs": """
        SELECT run_date, 'run-' || strftime(run_date, '%Y%m%d') AS run_id,
               CASE WHEN dayofweek(run_date) = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CAST(run_date AS TIMESTAMP) + INTERVAL 26 HOUR AS ingested_at
        FROM (SELECT DISTINCT CAST(day + CAST(lag AS INTEGER) AS DATE) AS run_date FROM ev, lags)""",
    "runs": "SELECT run_date, run_id, ingested_at FROM all_runs WHERE status = 'SUCCESS'",
    # events after three builds: which run an event comes from, which build wrote its partition
    "first_day": "SELECT min(day) AS lo FROM ev",
    "second_events": """
        SELECT *, CAST(received_at AS DATE) AS event_date FROM (
          SELECT 'e' || event_id AS event_key, media_id, day, lo,
                 CASE WHEN value < 200 THEN 'v' || user_id END AS visitor_key,
                 CASE WHEN event_type = 'purchase' AND value > 300 THEN NULL ELSE ts END AS received_at,
                 CASE WHEN day >= lo + 5 THEN least(value, 100.0) ELSE 0.0 END AS percent_viewed,
                 CASE WHEN day >= lo + 5 THEN 'run-20240131' ELSE 'run-20240130' END AS run_id
          FROM ev JOIN customer ON user_id = c_custkey, first_day)""",
    "second_parts": """
        SELECT event_date, CASE WHEN bool_or(day <= lo + 1) THEN 3 WHEN bool_or(day >= lo + 5) THEN 2 ELSE 1 END AS build
        FROM second_events GROUP BY event_date""",
    "landed_files": """
        SELECT media_id, 'events' AS endpoint, CASE WHEN page <= total // 100 THEN 100 ELSE total % 100 END AS records
        FROM (SELECT media_id, total, unnest(range(1, total // 100 + 2)) AS page
              FROM (SELECT media_id, count(*) AS total FROM engagement_events GROUP BY media_id))
        UNION ALL SELECT media_id, unnest(['media', 'media_stats', 'engagement']), 1 FROM media
        UNION ALL SELECT media_id, 'media_daily_stats', count(DISTINCT day) FROM ev GROUP BY media_id""",
    "landed_people": "SELECT count(DISTINCT user_id) AS n FROM ev JOIN customer ON user_id = c_custkey WHERE value < 200",
    "people": """
        SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "event_rows": """
        SELECT 'e' || event_id AS event_key, media_id,
               CASE WHEN value < 200 THEN 'v' || user_id END AS visitor_key,
               CASE WHEN event_type = 'purchase' AND value > 300 THEN NULL ELSE ts END AS received_at,
               least(value + lag, 100.0) AS percent_viewed,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS country,
               r_name AS region, c_mktsegment AS city,
               CAST(c_nationkey AS DOUBLE) AS lat, CAST(n_regionkey AS DOUBLE) AS lon,
               '10.0.0.' || user_id AS ip_address, lower(c_name) || '@example.com' AS email,
               c_mktsegment AS org, 'https://example.com/embed/' || k AS embed_url,
               'Media ' || k AS media_name, 'https://example.com/media/' || k AS media_url,
               CASE WHEN event_type = 'purchase' THEN 'purchase' END AS conversion_type,
               event_type AS browser, k AS browser_version, value > 50 AS is_mobile, r_name AS platform,
               runs.ingested_at, runs.run_id, runs.run_date AS ingestion_date
        FROM ev, lags, people, runs
        WHERE user_id = c_custkey
          AND runs.run_date = day + CAST(lag AS INTEGER)""",
    "silver_events": """
        SELECT * EXCLUDE (ingestion_date, place), CAST(received_at AS DATE) AS event_date FROM (
          SELECT *, row_number() OVER (PARTITION BY event_key ORDER BY ingested_at DESC) AS place
          FROM event_rows) WHERE place = 1""",
    "media_days": """
        SELECT media_id, day,
               count(*) FILTER (event_type = 'view') AS views,
               count(*) FILTER (event_type = 'click') AS clicks,
               count(*) FILTER (event_type = 'purchase') AS buys,
               count(DISTINCT user_id) AS users,
               (CAST(sum(CAST(value AS DECIMAL(28, 8))) AS DOUBLE) + sum(value - CAST(CAST(value AS DECIMAL(28, 8)) AS DOUBLE))) AS total,
               (CAST(sum(CAST(value AS DECIMAL(28, 8))) AS DOUBLE) + sum(value - CAST(CAST(value AS DECIMAL(28, 8)) AS DOUBLE))) / count(*) AS mean
        FROM ev GROUP BY ALL""",
    "daily_rows": """
        SELECT media_id, day AS stat_date, total / 3600.0 AS hours_watched,
               CASE WHEN clicks > 0 THEN views + lag * clicks END AS load_count,
               CASE WHEN views <> 3 THEN clicks END AS play_count,
               runs.ingested_at, runs.run_id
        FROM media_days, lags, runs WHERE runs.run_date = day + CAST(lag AS INTEGER)""",
    "silver_media_daily_stats": """
        SELECT * EXCLUDE place, CAST(year(stat_date) AS INTEGER) AS stat_year,
               CAST(month(stat_date) AS INTEGER) AS stat_month
        FROM (SELECT *, row_number() OVER (PARTITION BY media_id, stat_date ORDER BY ingested_at DESC) AS place
              FROM daily_rows) WHERE place = 1""",
    "silver_media_stats": """
        SELECT media_id, engagement, hours_watched, load_count, play_count, play_rate, visitors,
               snapshot_at, ingestion_date, run_id
        FROM (SELECT media_id, mean AS engagement, total / 3600.0 AS hours_watched, views AS load_count,
                     clicks AS play_count, CASE WHEN views > 0 THEN clicks / views END AS play_rate,
                     users AS visitors, runs.ingested_at AS snapshot_at, runs.run_date AS ingestion_date, run_id,
                     row_number() OVER (PARTITION BY media_id, run_id ORDER BY day DESC) AS place
              FROM media_days, lags, runs WHERE runs.run_date = day + CAST(lag AS INTEGER)) WHERE place = 1""",
    "curves": """
        SELECT media_id, day, (CAST(sum(CAST(value AS DECIMAL(28, 8))) AS DOUBLE) + sum(value - CAST(CAST(value AS DECIMAL(28, 8)) AS DOUBLE))) / count(*) AS engagement,
               """ + " || ',' || ".join(
        f"count(*) FILTER (least(floor(value / 10), 9) = {b})" for b in range(10)
    ) + """ AS engagement_data,
               """ + " || ',' || ".join(
        f"count(*) FILTER (least(floor(value / 10), 9) = {b} AND event_type = 'view')" for b in range(10)
    ) + """ AS rewatch_data
        FROM ev GROUP BY media_id, day""",
    "silver_engagement": """
        SELECT media_id, engagement, engagement_data, rewatch_data, snapshot_at, ingestion_date, run_id
        FROM (SELECT media_id, engagement, engagement_data, rewatch_data, runs.ingested_at AS snapshot_at,
                     runs.run_date AS ingestion_date, run_id,
                     row_number() OVER (PARTITION BY media_id, run_id ORDER BY day DESC) AS place
              FROM curves, lags, runs WHERE runs.run_date = day + CAST(lag AS INTEGER)) WHERE place = 1""",
    "media_versions": """
        SELECT 'm' || l_partkey AS media_id, l_partkey AS numeric_id, 'h' || l_partkey AS hashed_id,
               p_name AS title, p_brand AS description, p_size * 60.0::DOUBLE AS duration_seconds,
               p_type AS media_type, l_linestatus AS status, l_returnflag = 'R' AS archived,
               l_discount AS progress,
               CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) AS created_at,
               CASE WHEN l_tax > 0 THEN l_shipdate END AS updated_at,
               l_suppkey AS folder_id, 'f' || l_suppkey AS folder_hashed_id, p_brand AS folder_name,
               'https://example.com/t/' || l_partkey AS thumbnail_url,
               CAST(p_size AS BIGINT) AS thumbnail_width, CAST(p_size AS BIGINT) AS thumbnail_height,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 ELSE -1 END AS asset_count,
               CASE l_returnflag WHEN 'A' THEN '[{"content_type":"video/mp4","file_size":' || CAST(l_quantity AS BIGINT)
                    || ',"height":' || p_size || ',"type":"original","url":"https://example.com/a/' || l_orderkey
                    || '","width":' || p_size || '}]'
                 WHEN 'R' THEN '[]' END AS assets_json,
               DATE '2024-01-01' + l_linenumber AS run_date,
               'media-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || CAST(l_quantity AS BIGINT)
                 || '.json' AS file
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "silver_media": """
        SELECT * EXCLUDE (run_date, file, place), run_date AS ingestion_date FROM (
          SELECT v.*, runs.run_id, runs.ingested_at,
                 row_number() OVER (PARTITION BY media_id ORDER BY updated_at DESC NULLS LAST, ingested_at DESC, file DESC) AS place
          FROM media_versions v JOIN runs ON v.run_date = runs.run_date) WHERE place = 1""",
    "silver_visitors": """
        SELECT * EXCLUDE place FROM (
          SELECT 'v' || o_custkey AS visitor_key, CAST(DATE '2023-01-01' + c_nationkey AS TIMESTAMP) AS created_at,
                 o_orderdate AS last_active_at, 'o' || o_orderkey AS last_event_key,
                 CAST(floor(o_totalprice) AS BIGINT) AS load_count,
                 CAST(length(o_orderpriority) AS BIGINT) AS play_count,
                 lower(c_name) || '@example.com' AS email, c_name AS visitor_name,
                 c_mktsegment AS organization_name, o_orderstatus AS organization_title,
                 o_orderpriority AS browser, o_orderstatus AS browser_version, o_orderstatus = 'F' AS is_mobile,
                 r_name AS platform, runs.ingested_at, runs.run_id,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, ingested_at DESC,
                   'o' || o_orderkey DESC) AS place
          FROM orders JOIN people ON o_custkey = c_custkey
          JOIN runs ON runs.run_date = DATE '2024-01-01' + CAST(length(o_orderpriority) AS INTEGER))
        WHERE place = 1""",
    "dim_media": """
        SELECT media_id, numeric_id, hashed_id, title, description, duration_seconds, media_type, status,
               archived, created_at, updated_at, folder_name, thumbnail_url FROM silver_media""",
    "last_seen": """
        SELECT visitor_key, ip_address AS last_ip_address, country AS last_country, region AS last_region,
               city AS last_city, received_at AS last_event_at
        FROM (SELECT *, row_number() OVER (PARTITION BY visitor_key ORDER BY received_at DESC NULLS LAST,
                ip_address DESC, country DESC NULLS LAST, region DESC, city DESC) AS place
              FROM silver_events WHERE visitor_key IS NOT NULL) WHERE place = 1""",
    "dim_visitor": """
        SELECT v.visitor_key, created_at, last_active_at, load_count, play_count, email, visitor_name,
               organization_name, organization_title, browser, browser_version, is_mobile, platform,
               last_ip_address, last_country, last_region, last_city, last_event_at
        FROM silver_visitors v LEFT JOIN last_seen USING (visitor_key)""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year
        FROM (SELECT stat_date AS d FROM silver_media_daily_stats UNION SELECT event_date FROM silver_events)
        WHERE d IS NOT NULL""",
    "fact_engagement_event": """
        SELECT event_key, media_id, visitor_key, CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key,
               event_date, received_at, percent_viewed, country, region, city, ip_address, conversion_type,
               browser, browser_version, is_mobile, platform FROM silver_events""",
    "event_daily": """
        SELECT media_id, event_date AS stat_date, count(event_key) AS event_count,
               count(DISTINCT visitor_key) AS unique_visitors,
               (CAST(sum(CAST(percent_viewed AS DECIMAL(28, 8))) AS DOUBLE) + sum(percent_viewed - CAST(CAST(percent_viewed AS DECIMAL(28, 8)) AS DOUBLE))) / count(percent_viewed) AS watched_percent
        FROM silver_events GROUP BY ALL""",
    "fact_media_engagement": """
        SELECT d.media_id, d.stat_date, load_count, play_count, hours_watched AS total_watch_time_hours,
               coalesce(event_count, 0) AS event_count, coalesce(unique_visitors, 0) AS unique_visitors,
               watched_percent,
               CASE WHEN load_count > 0 THEN CAST(play_count AS DOUBLE) / load_count ELSE 0.0 END AS play_rate,
               hours_watched * 3600.0 AS total_watch_time_seconds,
               CAST(strftime(d.stat_date, '%Y%m%d') AS INTEGER) AS date_key,
               stat_year AS year, stat_month AS month
        FROM silver_media_daily_stats d LEFT JOIN event_daily e
          ON d.media_id = e.media_id AND d.stat_date = e.stat_date""",
    "unchecked": """
        SELECT CASE WHEN event_type = 'error' AND value < 5 THEN NULL
                    WHEN event_type = 'error' AND value < 10 THEN '  '
                    WHEN event_type = 'signup' THEN 's' || (event_id // 2)
                    ELSE 'e' || event_id END AS event_key,
               CASE WHEN event_type = 'error' AND value > 150 THEN NULL
                    WHEN event_type = 'error' AND value > 100 THEN 'x' || k ELSE media_id END AS media_id,
               CASE WHEN NOT (event_type = 'error' AND value BETWEEN 20 AND 40) THEN 'v' || user_id END AS visitor_key,
               ts AS received_at, day AS event_date, least(value, 100.0) AS percent_viewed
        FROM ev""",
    "media": "SELECT DISTINCT media_id FROM ev",
    "watermarks": """
        SELECT media_id, max(day) AS last_successful_end_date FROM ev WHERE value > 250 GROUP BY media_id""",
    "windows": """
        SELECT media_id, coalesce(last_successful_end_date - 1, DATE '2024-01-31' - 6) AS start_date,
               DATE '2024-01-31' AS end_date
        FROM media LEFT JOIN watermarks USING (media_id)""",
    "candidates": "SELECT media_id, min(day) AS last_successful_end_date FROM ev WHERE value > 200 GROUP BY media_id",
    "stage_audits": """
        SELECT CASE event_type WHEN 'click' THEN 'BRONZE_INGESTION' WHEN 'purchase' THEN 'GOLD_TRANSFORMATION'
                 ELSE upper(event_type) END AS pipeline_stage,
               'run-' || strftime(day, '%Y%m%d') AS run_id, max(ts) AS end_ts, count(DISTINCT media_id) AS candidates
        FROM ev WHERE dayofweek(day) <> 0 GROUP BY event_type, day""",
    "latest_stages": """
        SELECT pipeline_stage, run_id, end_ts, candidates FROM (
          SELECT *, row_number() OVER (PARTITION BY pipeline_stage ORDER BY end_ts DESC, run_id DESC) AS place
          FROM stage_audits) WHERE place = 1""",
    "engagement_events": """
        SELECT 'e' || event_id AS event_key, event_id, media_id, day, ts FROM ev""",
    "spine": """
        SELECT media_id, page, CASE WHEN page <= full_pages THEN 20 ELSE total - full_pages * 20 END AS records
        FROM (SELECT media_id, total, total // 20 AS full_pages, unnest(range(1, total // 20 + 2)) AS page
              FROM (SELECT media_id, count(e.event_id) AS total
                    FROM media LEFT JOIN engagement_events e USING (media_id) GROUP BY media_id))""",
    "observed_pages": """
        SELECT 'landed' AS source, media_id, page, records FROM spine
        UNION ALL
        SELECT 'by day', media_id, CAST(day(day) AS BIGINT), count(*) FROM ev GROUP BY media_id, day""",
    "payloads": """
        SELECT event_id, event_type AS dataset,
          CASE event_type
            WHEN 'click' THEN to_json({'events': [rec, rec]})
            WHEN 'purchase' THEN to_json([rec])
            WHEN 'view' THEN to_json({'r': {'q': {'p': rec.visitor}}})
            WHEN 'signup' THEN '[]'::JSON
            ELSE to_json({'late': value > 50, 'visitor_key': ''}) END AS body
        FROM (SELECT *, {'id': event_id, 'value': value, 'note': NULL::VARCHAR,
                'visitor': {'id': user_id, 'visitor_key': 'v' || user_id}} AS rec FROM ev)""",
    "json_nodes": """
        SELECT dataset, replace(replace(fullkey, '"', ''), '[0]', '[]') AS path,
               CASE type WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'integer'
                 WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string'
                 WHEN 'ARRAY' THEN 'array' ELSE 'object' END AS type
        FROM payloads, json_tree(payloads.body) WHERE NOT regexp_matches(fullkey, '\\[[1-9]')""",
}

ORACLES = {
    # scans and sinks
    "audit_success_runs": "SELECT run_id, ingested_at FROM runs",
    "media_id_list": """
        SELECT media_id, count(*) AS mentions FROM (
          SELECT media_id FROM ev UNION ALL SELECT 'm' || user_id FROM ev) GROUP BY media_id""",
    "watermark_state": """
        SELECT media_id, day AS last_successful_end_date FROM (
          SELECT media_id, max(day) AS day FROM ev WHERE event_type <> 'error' GROUP BY media_id, event_type)""",
    "bronze_events_scan": """
        SELECT event_key, media_id, visitor_key, received_at, percent_viewed, browser, is_mobile, run_id
        FROM (SELECT 'e' || event_id AS event_key, media_id,
                CASE WHEN value < 200 THEN 'v' || user_id END AS visitor_key,
                CASE WHEN event_type = 'purchase' AND value > 300 THEN NULL ELSE ts END AS received_at,
                least(value, 100.0) AS percent_viewed, event_type AS browser, value > 50 AS is_mobile,
                'run-20240131' AS run_id
              FROM ev JOIN customer ON user_id = c_custkey)""",
    "landed_page_files": """
        SELECT media_id, 'run-20240131' AS run_id, DATE '2024-01-31' AS ingestion_date, page,
               CASE WHEN page <= total // 100 THEN 100 ELSE total % 100 END AS records
        FROM (SELECT media_id, total, unnest(range(1, total // 100 + 2)) AS page
              FROM (SELECT media_id, count(*) AS total FROM engagement_events GROUP BY media_id))""",
    "landing_audit": """
        SELECT media_id, 'run-20240131' AS run_id, endpoint, count(*) AS pages_fetched,
               CAST(sum(records) AS BIGINT) AS records_fetched, count(*) AS bronze_object_count, 'SUCCESS' AS status
        FROM (SELECT media_id, 'events' AS endpoint,
                     CASE WHEN page <= total // 100 THEN 100 ELSE total % 100 END AS records
              FROM (SELECT media_id, total, unnest(range(1, total // 100 + 2)) AS page
                    FROM (SELECT media_id, count(*) AS total FROM engagement_events GROUP BY media_id))
              UNION ALL SELECT media_id, unnest(['media', 'media_stats', 'engagement']), 1 FROM media
              UNION ALL SELECT media_id, 'media_daily_stats', count(DISTINCT day) FROM ev GROUP BY media_id)
        GROUP BY media_id, endpoint""",
    "second_build": """
        SELECT event_key, media_id, visitor_key, received_at, percent_viewed, d.event_date, run_id, build
        FROM second_events d JOIN second_parts b ON d.event_date IS NOT DISTINCT FROM b.event_date""",
    "landing_record": """
        SELECT 'run-20240131' AS run_id, 'SUCCESS' AS status, (SELECT count(*) FROM media) AS media_count,
               (SELECT count(*) FROM landed_files) + n AS bronze_object_count, n AS visitor_objects_written,
               media_id, endpoint,
               CASE WHEN endpoint IN ('events', 'media_daily_stats') THEN '2023-11-03' END AS start_date,
               CASE WHEN endpoint IN ('events', 'media_daily_stats') THEN '2024-01-31' END AS end_date,
               count(*) AS pages_fetched, CAST(sum(records) AS BIGINT) AS records_fetched, count(*) AS objects,
               'SUCCESS' AS endpoint_status, '2024-01-31' AS candidate_end
        FROM landed_files, landed_people GROUP BY media_id, endpoint, n""",
    "commit_record": """
        SELECT unnest(['BRONZE_INGESTION', 'SILVER_TRANSFORMATION', 'GOLD_TRANSFORMATION', 'WATERMARK_COMMIT']) AS pipeline_stage,
               'SUCCESS' AS status, unnest([media, NULL, NULL, NULL]) AS media_count, unnest([NULL, NULL, NULL, media]) AS committed_media,
               unnest([NULL, 'run-20240131', 'run-20240131', 'run-20240131']) AS bronze_run_ids,
               unnest([NULL, NULL, NULL, true]) AS names_gold, unnest([NULL, NULL, NULL, 2]) AS decided_on,
               unnest([NULL, events, NULL, NULL]) AS events, unnest([NULL, NULL, events, NULL]) AS fact_events
        FROM (SELECT (SELECT count(*) FROM media) AS media, (SELECT count(*) FROM ev JOIN customer ON user_id = c_custkey) AS events)""",
    "catalog_tables": """
        SELECT 'dim_media' AS "tableName", count(*) AS "rows" FROM dim_media
        UNION ALL SELECT 'dim_visitor', count(*) FROM dim_visitor
        UNION ALL SELECT 'dim_date', count(*) FROM dim_date""",
    "end_to_end": """
        SELECT d.day AS stat_date, d.media_id, p_name AS title, views AS load_count, clicks AS play_count,
               CASE WHEN views > 0 THEN CAST(round(CAST(CAST(CAST(clicks AS DOUBLE) / views * 100 AS VARCHAR)
                 AS DECIMAL(38, 18)), 2) AS DOUBLE) ELSE 0.0 END AS play_rate_pct,
               CAST(round(CAST(CAST(total / 3600.0 AS VARCHAR) AS DECIMAL(38, 18)), 3) AS DOUBLE) AS total_watch_time_hours,
               coalesce(n, 0) AS event_count, coalesce(visitors, 0) AS unique_visitors,
               CAST(round(CAST(CAST(watched AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS avg_watched_percent,
               DATE '2024-01-31' AS last_successful_end_date
        FROM media_days d
        LEFT JOIN part ON d.media_id = 'm' || p_partkey
        LEFT JOIN (SELECT media_id, event_date, count(*) AS n, count(DISTINCT visitor_key) AS visitors,
                          (CAST(sum(CAST(percent_viewed AS DECIMAL(28, 8))) AS DOUBLE) + sum(percent_viewed - CAST(CAST(percent_viewed AS DECIMAL(28, 8)) AS DOUBLE))) / count(*) AS watched
                   FROM stream_events GROUP BY ALL) e ON d.media_id = e.media_id AND d.day = e.event_date""",
    "parquet_roundtrip": "SELECT * FROM fact_media_engagement",
    "partition_prune_read": """
        SELECT event_date, count(*) AS events FROM fact_engagement_event
        WHERE event_date IS NOT NULL GROUP BY event_date""",
    "catalog_partitions": """
        SELECT DISTINCT 'event_date=' || coalesce(CAST(event_date AS VARCHAR), '__HIVE_DEFAULT_PARTITION__')
          AS partition FROM fact_engagement_event""",
    "run_audit_counts": """
        SELECT 'media' AS table_name, count(*) AS row_count FROM silver_media
        UNION ALL SELECT 'media_stats', count(*) FROM silver_media_stats
        UNION ALL SELECT 'media_daily_stats', count(*) FROM silver_media_daily_stats
        UNION ALL SELECT 'engagement', count(*) FROM silver_engagement
        UNION ALL SELECT 'events', count(*) FROM silver_events
        UNION ALL SELECT 'visitors', count(*) FROM silver_visitors""",
    # lineage, deduplication, silver
    "lineage_from_path": """
        SELECT 'e' || event_id AS event_key, CAST(day + CAST(lag AS INTEGER) AS DATE) AS ingestion_date,
               'run-' || strftime(day + CAST(lag AS INTEGER), '%Y%m%d') AS run_id, media_id AS media_id_from_path
        FROM ev, lags""",
    "successful_run_rows": """
        SELECT run_id, ingested_at, count(*) AS landed_rows FROM event_rows GROUP BY ALL""",
    "silver_media": "SELECT * FROM silver_media",
    "silver_media_stats": "SELECT * FROM silver_media_stats",
    "silver_media_daily": "SELECT * FROM silver_media_daily_stats",
    "silver_engagement": "SELECT * FROM silver_engagement",
    "silver_events": "SELECT * FROM silver_events",
    "silver_visitors": "SELECT * FROM silver_visitors",
    "latest_by": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
          FROM orders) WHERE place = 1""",
    "snapshot_per_run": """
        SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL""",
    "latest_event_per_visitor": """
        SELECT visitor_key, last_event_at AS received_at, last_ip_address AS ip_address, last_country AS country,
               last_region AS region, last_city AS city FROM last_seen""",
    "required_runs": "SELECT run_id FROM runs",
    "missing_visitors": """
        SELECT 'events' AS dataset, count(*) AS landed_rows FROM ev JOIN customer ON user_id = c_custkey
        UNION ALL SELECT 'visitors', 0""",
    "quarantined_files": """
        SELECT media_id, 'run-20240131' AS run_id, '{"load_count":' || views || ',"play_count":' || clicks AS body
        FROM (SELECT media_id, CAST(sum(views) AS BIGINT) AS views, CAST(sum(clicks) AS BIGINT) AS clicks
              FROM media_days GROUP BY media_id) WHERE views % 2 = 1""",
    "overlap_idempotence": "SELECT * FROM silver_events",
    "stream_append_events": "SELECT * FROM stream_events",
    "stream_merge_events": "SELECT * FROM stream_events",
    # gold
    "dim_media": "SELECT * FROM dim_media",
    "dim_visitor": "SELECT * FROM dim_visitor",
    "dim_visitor_from_events": """
        SELECT visitor_key, NULL::TIMESTAMP AS created_at, NULL::TIMESTAMP AS last_active_at,
               NULL::BIGINT AS load_count, NULL::BIGINT AS play_count, NULL::VARCHAR AS email,
               NULL::VARCHAR AS visitor_name, NULL::VARCHAR AS organization_name,
               NULL::VARCHAR AS organization_title, NULL::VARCHAR AS browser, NULL::VARCHAR AS browser_version,
               NULL::BOOLEAN AS is_mobile, NULL::VARCHAR AS platform,
               last_ip_address, last_country, last_region, last_city, last_event_at FROM last_seen""",
    "dim_date": "SELECT * FROM dim_date",
    "event_daily": "SELECT * FROM event_daily",
    "fact_engagement_event": "SELECT * FROM fact_engagement_event",
    "fact_media_engagement": "SELECT * FROM fact_media_engagement",
    # reports
    "gold_table_row_counts": """
        SELECT 'dim_media' AS table_name, count(*) AS row_count FROM dim_media
        UNION ALL SELECT 'dim_visitor', count(*) FROM dim_visitor
        UNION ALL SELECT 'dim_date', count(*) FROM dim_date
        UNION ALL SELECT 'fact_media_engagement', count(*) FROM fact_media_engagement
        UNION ALL SELECT 'fact_engagement_event', count(*) FROM fact_engagement_event
        ORDER BY table_name""",
    "media_listing": """
        SELECT media_id, title, duration_seconds, media_type, status, created_at, updated_at
        FROM dim_media ORDER BY media_id""",
    "daily_engagement_report": """
        SELECT f.stat_date, f.media_id, m.title, f.load_count, f.play_count,
               CAST(round(CAST(CAST(f.play_rate * 100 AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS play_rate_pct,
               CAST(round(CAST(CAST(f.total_watch_time_hours AS VARCHAR) AS DECIMAL(38, 18)), 3) AS DOUBLE) AS total_watch_time_hours,
               f.event_count, f.unique_visitors,
               CAST(round(CAST(CAST(f.watched_percent AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS avg_watched_percent
        FROM fact_media_engagement f LEFT JOIN dim_media m ON f.media_id = m.media_id
        ORDER BY f.stat_date, m.title, f.media_id""",
    "engagement_by_country": """
        SELECT coalesce(country, 'UNKNOWN') AS country, count(*) AS event_count,
               count(DISTINCT visitor_key) AS unique_visitors,
               CAST(round(CAST(CAST((CAST(sum(CAST(percent_viewed AS DECIMAL(28, 8))) AS DOUBLE) + sum(percent_viewed - CAST(CAST(percent_viewed AS DECIMAL(28, 8)) AS DOUBLE))) / count(percent_viewed)
                 AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS avg_percent_viewed
        FROM fact_engagement_event GROUP BY 1 ORDER BY event_count DESC, country""",
    "orphan_media_rows": """
        SELECT count(*) AS orphan_media_rows
        FROM (SELECT DISTINCT media_id, event_date FROM unchecked) f LEFT JOIN dim_media d ON f.media_id = d.media_id
        WHERE d.media_id IS NULL""",
    "orphan_event_rows": """
        SELECT count(*) AS orphan_event_media_rows FROM unchecked f LEFT JOIN dim_media d ON f.media_id = d.media_id
        WHERE d.media_id IS NULL""",
    "duplicate_daily_keys": """
        SELECT media_id, stat_date, count(*) AS duplicate_count FROM daily_rows
        GROUP BY media_id, stat_date HAVING count(*) > 1""",
    "duplicate_event_keys": """
        SELECT event_key, count(*) AS duplicate_count FROM unchecked GROUP BY event_key HAVING count(*) > 1""",
    "date_dim_check": """
        SELECT f.stat_date, f.date_key, d.full_date, d.day_name, d.week_of_year
        FROM fact_media_engagement f LEFT JOIN dim_date d ON f.date_key = d.date_key
        ORDER BY f.stat_date, f.media_id LIMIT 50""",
    "media_kpis": """
        SELECT media_id, title, total_plays, total_loads, watch_time_hours, total_events,
               CASE WHEN total_loads > 0 THEN CAST(total_plays AS DOUBLE) / total_loads ELSE 0.0 END AS play_rate
        FROM (SELECT media_id, CAST(sum(play_count) AS BIGINT) AS total_plays,
                     CAST(sum(load_count) AS BIGINT) AS total_loads,
                     (CAST(sum(CAST(total_watch_time_hours AS DECIMAL(28, 8))) AS DOUBLE) + sum(total_watch_time_hours - CAST(CAST(total_watch_time_hours AS DECIMAL(28, 8)) AS DOUBLE))) AS watch_time_hours,
                     CAST(sum(event_count) AS BIGINT) AS total_events
              FROM fact_media_engagement GROUP BY media_id) LEFT JOIN dim_media USING (media_id)""",
    "plays_over_time": """
        SELECT stat_date, CAST(sum(play_count) AS BIGINT) AS total_plays,
               CAST(sum(load_count) AS BIGINT) AS total_loads,
               (CAST(sum(CAST(total_watch_time_hours AS DECIMAL(28, 8))) AS DOUBLE) + sum(total_watch_time_hours - CAST(CAST(total_watch_time_hours AS DECIMAL(28, 8)) AS DOUBLE))) AS watch_time_hours
        FROM fact_media_engagement GROUP BY stat_date ORDER BY stat_date""",
    "overall_kpis": """
        SELECT total_plays, total_loads, watch_time_hours,
               CASE WHEN total_loads > 0 THEN CAST(total_plays AS DOUBLE) / total_loads ELSE 0.0 END AS play_rate
        FROM (SELECT CAST(sum(play_count) AS BIGINT) AS total_plays, CAST(sum(load_count) AS BIGINT) AS total_loads,
                     (CAST(sum(CAST(total_watch_time_hours AS DECIMAL(28, 8))) AS DOUBLE) + sum(total_watch_time_hours - CAST(CAST(total_watch_time_hours AS DECIMAL(28, 8)) AS DOUBLE))) AS watch_time_hours
              FROM fact_media_engagement)""",
    # quality
    "blank_key_rows": "SELECT * FROM unchecked WHERE event_key IS NULL OR trim(event_key) = ''",
    "dq_null_keys": """
        SELECT count(*) AS rows, count(*) FILTER (event_key IS NULL OR trim(event_key) = '') AS blank_event_key,
               count(*) FILTER (media_id IS NULL OR trim(media_id) = '') AS blank_media_id FROM unchecked""",
    "dq_duplicates": """
        SELECT count(*) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM unchecked GROUP BY event_key HAVING count(*) > 1)""",
    "fk_violations": """
        SELECT DISTINCT media_id FROM unchecked
        WHERE media_id IS NOT NULL AND media_id NOT IN (SELECT media_id FROM dim_media)""",
    "contract_check": """
        SELECT subject, declared, found, CASE WHEN found IS NULL THEN 'missing' ELSE 'ok' END AS verdict
        FROM (VALUES
          ('event_key', 'string', 'string'), ('media_id', 'string', 'string'), ('visitor_key', 'string', 'string'),
          ('received_at', 'timestamp', 'timestamp'), ('percent_viewed', 'double', 'double'),
          ('event_date', 'date', 'date'), ('country', 'string', NULL), ('region', 'string', NULL),
          ('city', 'string', NULL), ('lat', 'double', NULL), ('lon', 'double', NULL), ('ip_address', 'string', NULL),
          ('email', 'string', NULL), ('org', 'string', NULL), ('embed_url', 'string', NULL),
          ('media_name', 'string', NULL), ('media_url', 'string', NULL), ('conversion_type', 'string', NULL),
          ('browser', 'string', NULL), ('browser_version', 'string', NULL), ('is_mobile', 'boolean', NULL),
          ('platform', 'string', NULL), ('ingested_at', 'timestamp', NULL), ('run_id', 'string', NULL)
        ) AS t(subject, declared, found)
        UNION ALL
        SELECT '(blank keys)', '0', CAST(n AS VARCHAR), CASE WHEN n = 0 THEN 'ok' ELSE 'broken' END
        FROM (SELECT count(*) AS n FROM unchecked WHERE event_key IS NULL OR trim(event_key) = '')
        UNION ALL
        SELECT '(surplus rows)', '0', CAST(n AS VARCHAR), CASE WHEN n = 0 THEN 'ok' ELSE 'broken' END
        FROM (SELECT CAST(sum(n - 1) AS BIGINT) AS n FROM (SELECT count(*) AS n FROM unchecked GROUP BY event_key))""",
    "pii_safe_events": """
        SELECT * REPLACE (left(sha256(ip_address), 24) AS ip_address, left(sha256(email), 24) AS email)
        FROM silver_events""",
    # pages
    "page_assignment": """
        SELECT media_id, event_key, lpad(CAST((place - 1) // 20 + 1 AS VARCHAR), 6, '0') AS page FROM (
          SELECT media_id, event_key, row_number() OVER (PARTITION BY media_id ORDER BY ts, event_id) AS place
          FROM engagement_events)""",
    "page_spine": "SELECT media_id, page, records FROM spine",
    "page_completeness": """
        SELECT *, first_page = 1 AND last_page = pages AND full_pages = pages - 1 AND last_page_records < 20 AS complete,
               last_page > 10000 OR (last_page = 10000 AND last_page_records >= 20) AS over_limit
        FROM (SELECT source, media_id, min(page) AS first_page, max(page) AS last_page, count(*) AS pages,
                     CAST(sum(records) AS BIGINT) AS records, count(*) FILTER (records = 20) AS full_pages,
                     max_by(records, page) AS last_page_records
              FROM observed_pages GROUP BY source, media_id)""",
    "endpoint_audit": """
        SELECT o.media_id, endpoint, count(*) AS pages_fetched, CAST(sum(records) AS BIGINT) AS records_fetched,
               count(*) AS bronze_object_count,
               CASE WHEN endpoint IN ('media_daily_stats', 'events') THEN any_value(start_date) END AS start_date,
               CASE WHEN endpoint IN ('media_daily_stats', 'events') THEN any_value(end_date) END AS end_date,
               'SUCCESS' AS status
        FROM (SELECT media_id, 'events' AS endpoint, records FROM spine
              UNION ALL SELECT media_id, unnest(['media', 'media_stats', 'engagement']), 1 FROM media
              UNION ALL SELECT media_id, 'media_daily_stats', count(DISTINCT day) FROM ev GROUP BY media_id) o
        LEFT JOIN windows w ON o.media_id = w.media_id GROUP BY o.media_id, endpoint""",
    "visitor_discovery": """
        SELECT DISTINCT 'v' || user_id AS visitor_key FROM ev
        WHERE value < 200 ORDER BY visitor_key""",
    # incremental state
    "date_windows": "SELECT media_id, start_date, end_date FROM windows",
    "incremental_events": """
        SELECT e.event_key, e.media_id, e.day FROM engagement_events e JOIN windows w
          ON e.media_id = w.media_id AND e.day BETWEEN w.start_date AND w.end_date""",
    "watermark_merge": """
        SELECT media_id, coalesce(c.last_successful_end_date, w.last_successful_end_date) AS last_successful_end_date
        FROM watermarks w FULL JOIN candidates c USING (media_id)""",
    "watermark_merge_monotonic": """
        SELECT media_id, greatest(c.last_successful_end_date, w.last_successful_end_date) AS last_successful_end_date
        FROM watermarks w FULL JOIN candidates c USING (media_id)""",
    "latest_success_per_stage": "SELECT pipeline_stage, run_id, end_ts FROM latest_stages",
    "commit_gate": """
        SELECT *, gold_end >= bronze_end AS gold_is_newer,
               date_diff('microsecond', bronze_end, TIMESTAMP '2024-02-01 00:00:00') <= 48 * 3600000000 AS fresh,
               candidates > 0 AS has_candidates,
               gold_end >= bronze_end AND candidates > 0
                 AND date_diff('microsecond', bronze_end, TIMESTAMP '2024-02-01 00:00:00') <= 48 * 3600000000 AS may_commit
        FROM (SELECT max(run_id) FILTER (pipeline_stage = 'BRONZE_INGESTION') AS bronze_run_id,
                     max(run_id) FILTER (pipeline_stage = 'GOLD_TRANSFORMATION') AS gold_run_id,
                     max(end_ts) FILTER (pipeline_stage = 'BRONZE_INGESTION') AS bronze_end,
                     max(end_ts) FILTER (pipeline_stage = 'GOLD_TRANSFORMATION') AS gold_end,
                     coalesce(max(candidates) FILTER (pipeline_stage = 'BRONZE_INGESTION'), 0) AS candidates
              FROM latest_stages)""",
    # scalar functions
    "date_parts": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
               CAST(month(o_orderdate) AS INTEGER) AS month, dayname(o_orderdate) AS day_name,
               CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year FROM orders""",
    "pseudonymize": "SELECT c_custkey, left(sha256(c_name), 24) AS pseudonym FROM customer",
    "nested_flatten": """
        SELECT numeric_id, folder_id, folder_name, thumbnail_url, asset_count, assets_json FROM media_versions""",
    "scalar_cleanup": """
        SELECT event_id, event_type IN ('click', 'view') AS yes,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS number,
               coalesce(CASE WHEN value < 50 THEN media_id END, 'UNKNOWN') AS label,
               CAST(date_diff('microsecond', ts, TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 3.6e9 AS age,
               left(props, 4) AS short_text FROM ev_props""",
    # JSON profiling
    "json_schema_profile": "SELECT dataset, path, type, count(*) AS payloads FROM json_nodes GROUP BY ALL",
    "json_record_count": """
        SELECT event_id, CASE dataset WHEN 'click' THEN 2 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 0 END::BIGINT
          AS records FROM payloads""",
    "json_find_first": """
        SELECT event_id, CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 'v' || user_id END AS first_value
        FROM ev""",
    "json_endpoint_report": """
        SELECT event_type AS dataset, CASE WHEN event_type IN ('purchase', 'signup') THEN 'array' ELSE 'object' END
                 AS response_type, count(*) AS payloads,
               CASE event_type WHEN 'click' THEN 2 * count(*) WHEN 'purchase' THEN count(*) WHEN 'signup' THEN 0 END
                 AS records
        FROM ev GROUP BY event_type""",
}

FRAGMENTS["ev_props"] = "SELECT ev.*, props FROM ev JOIN events USING (event_id)"
# the stream lands every engagement event once, in one run
FRAGMENTS["stream_events"] = """
    SELECT event_key, media_id, visitor_key, received_at, least(value, 100.0) AS percent_viewed,
           CAST(received_at AS DATE) AS event_date
    FROM (SELECT 'e' || event_id AS event_key, media_id, CASE WHEN value < 200 THEN 'v' || user_id END AS visitor_key,
                 CASE WHEN event_type = 'purchase' AND value > 300 THEN NULL ELSE ts END AS received_at, value
          FROM ev JOIN customer ON user_id = c_custkey)"""


def with_fragments(query: str) -> str:
    """The query with the table expressions it needs, each after those it needs itself."""
    needed: list[str] = []

    def need(text: str, skip: str = "") -> None:
        for name, body in FRAGMENTS.items():
            if name != skip and name not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                need(body, name)
                needed.append(name)

    need(query)
    clauses = ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in needed)
    return f"WITH {clauses}\n{query}" if needed else query


def oracle_sql() -> dict[str, str]:
    return {name: with_fragments(query) for name, query in ORACLES.items()}

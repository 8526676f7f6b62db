-- Reports over the views `telemetry`, `service_cuts`, `endpoint_cuts` (exact percentiles of
-- telemetry), `ground_truth` and `fault_windows`.
-- A statement runs from its @name marker to the next one.

-- @name service_latency_profile
WITH latency AS (
  SELECT service_name,
         count(*)                                                      AS span_count,
         avg(response_time_ms)                                         AS mean_ms,
         max(response_time_ms)                                         AS max_ms,
         sum(is_failure)                                               AS failed_spans
  FROM telemetry
  GROUP BY service_name
)
SELECT latency.service_name,
       span_count,
       round(mean_ms, 3)                                               AS mean_latency_ms,
       round(p50, 3)                                                   AS p50_latency_ms,
       round(p95, 3)                                                   AS p95_latency_ms,
       round(p99, 3)                                                   AS p99_latency_ms,
       round(max_ms, 3)                                                AS max_latency_ms,
       failed_spans,
       cast(round(100.0 * failed_spans / span_count, 3) AS double)     AS failure_rate_pct
FROM latency
LEFT JOIN service_cuts AS cuts ON cuts.service_name <=> latency.service_name
ORDER BY failure_rate_pct DESC, latency.service_name

-- @name endpoint_hotspots
WITH operation AS (
  SELECT service_name, endpoint,
         count(*)                                  AS calls,
         avg(response_time_ms)                     AS mean_ms,
         sum(is_failure)                           AS failed_calls
  FROM telemetry
  GROUP BY service_name, endpoint
)
SELECT operation.service_name, operation.endpoint, calls,
       round(mean_ms, 3)                                        AS mean_latency_ms,
       round(p95, 3)                                            AS p95_latency_ms,
       failed_calls,
       cast(round(100.0 * failed_calls / calls, 3) AS double)   AS failure_rate_pct
FROM operation
LEFT JOIN endpoint_cuts AS cuts
  ON cuts.service_name <=> operation.service_name AND cuts.endpoint <=> operation.endpoint
WHERE calls >= 100
ORDER BY p95_latency_ms DESC, operation.service_name, operation.endpoint
LIMIT 50

-- @name trace_depth_distribution
-- Bands count the spans of a trace, not the length of its longest call path.
-- Fixed values: upper bounds and labels of the bands.
WITH per_trace AS (
  SELECT trace_id, count(*) AS spans, sum(is_failure) AS failed
  FROM telemetry
  GROUP BY trace_id
)
SELECT CASE
         WHEN spans <= 1  THEN '1 span'
         WHEN spans <= 5  THEN '2-5 spans'
         WHEN spans <= 10 THEN '6-10 spans'
         WHEN spans <= 20 THEN '11-20 spans'
         ELSE '21+ spans'
       END         AS span_count_bucket,
       count(*)    AS trace_count,
       sum(failed) AS failed_spans
FROM per_trace
GROUP BY ALL
ORDER BY trace_count DESC, span_count_bucket

-- @name service_failure_ranking
-- The unpartitioned windows see one row per service.
WITH busy AS (
  SELECT service_name,
         count(*)        AS span_count,
         sum(is_failure) AS failed_spans,
         cast(round(100.0 * sum(is_failure) / count(*), 3) AS double) AS failure_rate_pct
  FROM telemetry
  GROUP BY service_name
  HAVING span_count >= 50
)
SELECT service_name, span_count, failed_spans, failure_rate_pct,
       rank()   OVER (ORDER BY failure_rate_pct DESC)               AS failure_rank,
       ntile(4) OVER (ORDER BY failure_rate_pct DESC, service_name) AS failure_quartile
FROM busy
ORDER BY failure_rank, service_name

-- @name hourly_failure_trend
-- The previous hour is the service's previous hour with traffic.
WITH hourly AS (
  SELECT service_name,
         date_trunc('HOUR', start_time_ts) AS bucket_hour,
         count(*)        AS spans,
         sum(is_failure) AS failed,
         cast(round(100.0 * sum(is_failure) / count(*), 3) AS double) AS failure_rate_pct
  FROM telemetry
  WHERE start_time_ts IS NOT NULL
  GROUP BY ALL
)
SELECT *,
       lag(failure_rate_pct) OVER (PARTITION BY service_name ORDER BY bucket_hour)
         AS previous_hour_failure_rate_pct
FROM hourly
ORDER BY service_name, bucket_hour

-- @name ground_truth_evaluation
-- `fault_windows` has a row per injection and second of its window.
SELECT inject_service, inject_type,
       count(DISTINCT inject_timestamp) AS injections,
       sum(spans)                       AS spans_observed,
       sum(failures)                    AS failures_observed,
       cast(round(100.0 * sum(failures) / nullif(sum(spans), 0), 3) AS double)
         AS failure_rate_in_window_pct
FROM fault_windows
GROUP BY inject_service, inject_type
ORDER BY failure_rate_in_window_pct DESC NULLS LAST, inject_service, inject_type

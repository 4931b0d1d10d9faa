"""DuckDB text for the independent check of every SQL-expressible query.

The ``logs`` CTE rebuilds, in DuckDB SQL, the same access-log lines the Spark
fixture writes (``sources/fixtures.py``) and parses them with the same
pattern using DuckDB's own regex engine and time parser.  Output rules so
both engines produce identical values:

* instants become UTC wall-clock ``TIMESTAMP`` (``AT TIME ZONE 'UTC'``);
* DuckDB's HUGEINT sums and BIGINT ``hour`` are cast to Spark's types;
* doubles are rounded to 6 places on both sides;
* Spark's ``dayofweek`` is DuckDB's plus one.
"""

from __future__ import annotations

from logsmith.functions.logline import LOG_PATTERN

_P = LOG_PATTERN.replace("'", "''")

LINES_CTE = """lines AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN 'junk ' || CAST(event_id AS VARCHAR) ELSE
    (CASE WHEN user_id < 20 THEN '10.0.0.1'
          WHEN user_id % 3 = 0 THEN 'host-' || CAST(user_id AS VARCHAR) || '.example.com'
          ELSE '10.0.1.' || CAST(user_id AS VARCHAR) END)
    || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
    || (CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END)
    || ' /' || event_type || '/' || json_extract_string(props, '$.k')
    || (CASE WHEN event_id % 53 = 0 THEN '' ELSE ' HTTP/1.0' END) || '" '
    || (CASE WHEN event_id % 97 = 0 THEN '-'
             WHEN user_id % 25 = 22 THEN '403'
             WHEN event_type = 'error' THEN (CASE WHEN user_id % 2 = 0 THEN '404' ELSE '500' END)
             WHEN event_type = 'click' THEN '302'
             ELSE '200' END)
    || ' ' || (CASE WHEN event_id % 13 = 0 THEN '-'
                    ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END)
  END AS value
  FROM events
)"""

FIELDS_CTE = f"""fields AS (
  SELECT regexp_extract(value, '{_P}', 1) AS ip,
         regexp_extract(value, '{_P}', 2) AS client_identity,
         regexp_extract(value, '{_P}', 3) AS user_id,
         regexp_extract(value, '{_P}', 4) AS timestamp_str,
         regexp_extract(value, '{_P}', 5) AS method,
         regexp_extract(value, '{_P}', 6) AS url,
         regexp_extract(value, '{_P}', 7) AS protocol,
         regexp_extract(value, '{_P}', 8) AS status_str,
         regexp_extract(value, '{_P}', 9) AS bytes_str
  FROM lines
)"""

LOGS_CTE = """typed AS (
  SELECT ip,
         (try_strptime(timestamp_str, '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC') AS ts,
         method, url, protocol,
         CASE WHEN status_str = '-' THEN NULL ELSE TRY_CAST(status_str AS INTEGER) END AS status,
         CASE WHEN bytes_str = '-' THEN CAST(0 AS BIGINT) ELSE TRY_CAST(bytes_str AS BIGINT) END AS bytes
  FROM fields
  WHERE ip <> '' AND timestamp_str <> ''
),
logs AS (
  SELECT ip, ts AS "timestamp", method, url, protocol, status, bytes,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
         strftime(ts, '%Y-%m-%d') AS date,
         CASE WHEN status >= 400 THEN 1 ELSE 0 END AS is_error,
         CASE WHEN status BETWEEN 200 AND 299 THEN '2xx_success'
              WHEN status BETWEEN 300 AND 399 THEN '3xx_redirect'
              WHEN status BETWEEN 400 AND 499 THEN '4xx_client_error'
              WHEN status BETWEEN 500 AND 599 THEN '5xx_server_error'
              ELSE 'unknown' END AS status_category,
         strftime(ts, '%Y-%m-%d %H:%M') AS minute
  FROM typed
)"""


def with_logs(body: str, extra_ctes: str = "") -> str:
    """``WITH lines, fields, typed, logs[, extra] <body>``."""
    ctes = ",\n".join([LINES_CTE, FIELDS_CTE, LOGS_CTE] + ([extra_ctes] if extra_ctes else []))
    recursive = "RECURSIVE " if "reach(" in extra_ctes else ""
    return f"WITH {recursive}{ctes}\n{body}"


def with_lines(body: str, extra_ctes: str = "") -> str:
    ctes = ",\n".join([LINES_CTE] + ([extra_ctes] if extra_ctes else []))
    return f"WITH {ctes}\n{body}"


def with_fields(body: str) -> str:
    return f"WITH {LINES_CTE},\n{FIELDS_CTE}\n{body}"

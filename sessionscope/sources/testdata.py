"""The driver's test tables seen as an action log and a user table.

``events`` becomes ``user_visit_action`` and ``customer`` joined with
``nation`` becomes ``user_info``. The relabelling is a test fixture; the
library works on any table with the action and user schemas.

Four clocks say what a session is and place its events in time: ``second``
(one user's actions on one day, time of day in whole seconds), ``minute`` (the
same sessions, minutes read as seconds: ``13:07:42`` becomes ``00:13:07``),
``hour`` (a user's actions in five days, hours since their start read as
seconds) and ``month`` (a user's actions in a month, real seconds). Together
they put sessions into every visit-length and step-length bucket.

Each adapter has its DuckDB twin (``*_SQL``) so oracle queries see the very
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


CLOCKS = ("second", "minute", "hour", "month")


# The driver tables' schemas, declared so that reads skip footer inference.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


# Of each clock: the session's first day and its key (``{day}`` is the day),
# and the seconds behind midnight of that day.
_SPARK_CLOCKS = {
    "second": ("to_date(ts)", "replace(CAST(to_date(ts) AS STRING), '-', '')",
               "hour(ts) * 3600 + minute(ts) * 60 + second(ts)"),
    "minute": ("to_date(ts)", "replace(CAST(to_date(ts) AS STRING), '-', '')", "hour(ts) * 60 + minute(ts)"),
    "hour": ("date_sub(to_date(ts), datediff(to_date(ts), DATE '2024-01-01') % 5)",
             "concat('b', CAST(datediff(to_date(ts), DATE '2024-01-01') div 5 AS STRING))",
             "(datediff(to_date(ts), DATE '2024-01-01') % 5) * 24 + hour(ts)"),
    "month": ("to_date(ts)", "substring(CAST(to_date(ts) AS STRING), 1, 7)",
              "hour(ts) * 3600 + minute(ts) * 60 + second(ts)"),
}


def actions_from_events(events: DataFrame, clock: str = "minute") -> DataFrame:
    """``events`` as an action log (schema ``ACTION_SCHEMA``)."""
    if clock not in CLOCKS:
        raise ValueError(f"clock must be one of {CLOCKS}, got {clock!r}")
    day, key, secs = _SPARK_CLOCKS[clock]
    return events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    ).selectExpr(
        "event_id AS action_id",
        "to_date(ts) AS date",
        "user_id",
        f"concat_ws('_', CAST(user_id AS STRING), {key}) AS session_id",
        "event_id % 10 AS page_id",
        f"timestampadd(SECOND, {secs}, CAST({day} AS TIMESTAMP_NTZ)) AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k AS STRING)) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id",
        "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS order_category_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS STRING) END AS order_product_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS pay_category_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS STRING) END AS pay_product_ids",
    )


def users_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``customer`` joined with ``nation`` as a user table (``USER_SCHEMA``)."""
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = nation.selectExpr("n_nationkey AS c_nationkey", "n_name")
    return c.join(n, "c_nationkey", "left").selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(18 + c_custkey % 50 AS INT) AS age",
        "c_mktsegment AS professional",
        "n_name AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_actions(spark: SparkSession, sf_dir: str, clock: str = "minute") -> DataFrame:
    """The action log. A later ``date`` range predicate needs no help: the
    optimizer rewrites ``to_date(ts) BETWEEN a AND b`` into bounds on ``ts``
    and pushes them into the parquet scan (``PushedFilters``)."""
    return actions_from_events(_table(spark, sf_dir, "events"), clock)


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_customers(_table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation"))


# ---- DuckDB twins of the adapters (oracle side) -------------------------

_DAYS_SQL = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"
_DUCKDB_CLOCKS = {
    "second": ("CAST(ts AS DATE)", "strftime(ts, '%Y%m%d')", "hour(ts) * 3600 + minute(ts) * 60 + second(ts)"),
    "minute": ("CAST(ts AS DATE)", "strftime(ts, '%Y%m%d')", "hour(ts) * 60 + minute(ts)"),
    "hour": (f"CAST(DATE '2024-01-01' + CAST(5 * ({_DAYS_SQL} // 5) AS INTEGER) AS DATE)",
             f"'b' || CAST({_DAYS_SQL} // 5 AS VARCHAR)", f"({_DAYS_SQL} % 5) * 24 + hour(ts)"),
    "month": ("CAST(ts AS DATE)", "strftime(ts, '%Y-%m')", "hour(ts) * 3600 + minute(ts) * 60 + second(ts)"),
}


def actions_sql(clock: str = "minute") -> str:
    day, key, secs = _DUCKDB_CLOCKS[clock]
    return f"""
    SELECT event_id AS action_id,
           CAST(ts AS DATE) AS date,
           user_id,
           CAST(user_id AS VARCHAR) || '_' || {key} AS session_id,
           event_id % 10 AS page_id,
           CAST({day} AS TIMESTAMP) + to_seconds({secs}) AS action_time,
           CASE WHEN event_type = 'view' THEN 'kw' || CAST(k AS VARCHAR) END AS search_keyword,
           CASE WHEN event_type = 'click' THEN k END AS click_category_id,
           CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
           CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_category_ids,
           CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
           CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
           CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
    """


USERS_SQL = """
    SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
           CAST(18 + c_custkey % 50 AS INTEGER) AS age,
           c_mktsegment AS professional, n_name AS city,
           CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

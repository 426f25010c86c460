"""Batch forms of the event-time operators, over the whole events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.events import event_time, sessions, windowed
from .common import table


def str_tumbling(spark, d):
    x = windowed(event_time(table(spark, d, "events")), "1 day")
    return x.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


def str_sliding(spark, d):
    x = windowed(event_time(table(spark, d, "events")), "2 days", "1 day")
    return x.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def str_sessions(spark, d):
    return sessions(event_time(table(spark, d, "events")), "6 hours").groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


QUERIES = {f.__name__: f for f in (str_tumbling, str_sliding, str_sessions)}

ORACLE = {
    "str_tumbling": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value::DECIMAL(18,4))::DOUBLE, 2) AS total FROM events GROUP BY 1, 2",
    "str_sliding": "SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS d FROM events) GROUP BY 1, 2",
    "str_sessions": "WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS s FROM events), g AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM x), c AS (SELECT user_id, g, count(*) AS n FROM g GROUP BY 1, 2) SELECT user_id, count(*) AS sessions, max(n) AS longest FROM c GROUP BY 1",
}

"""Registered queries: fixed-weight recursions over the event table as one series."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.operators import recursions
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.sources.tables import table

EVENTS = "e AS (SELECT event_id, value::DOUBLE AS y, row_number() OVER (ORDER BY ts, event_id) AS t FROM events WHERE value IS NOT NULL)"


def _events(spark, sf):
    return table(spark, sf, "events").filter(F.col("value").isNotNull()).select("event_id", "ts", "value")


@register("long_smoothing_events", f"""
WITH RECURSIVE {EVENTS},
h AS (SELECT avg(y) FILTER (t <= 12) AS a, avg(y) FILTER (t > 12 AND t <= 24) AS b, count(*) AS n,
             list(y ORDER BY t) FILTER (t <= 12) AS ys FROM e),
r AS (SELECT 0::BIGINT AS t, NULL::BIGINT AS event_id, a AS level, (b - a) / 12 AS trend, list_transform(ys, lambda v: v - a) AS season,
             NULL::DOUBLE AS forecast, NULL::DOUBLE AS error FROM h WHERE n >= 24
      UNION ALL
      SELECT t, event_id, level, new_trend, list_append(season[2:], 0.2 * (y - level) + 0.8 * season[1]), forecast, y - forecast
      FROM (SELECT *, 0.1 * (level - old) + 0.9 * trend AS new_trend
            FROM (SELECT e.t, e.event_id, e.y, r.trend, r.season, r.level AS old, 0.3 * (e.y - r.season[1]) + 0.7 * (r.level + r.trend) AS level,
                         r.level + r.trend + r.season[1] AS forecast FROM r JOIN e ON e.t = r.t + 1)))
SELECT event_id, round(forecast, 6) AS forecast, round(error, 6) AS error FROM r WHERE t > 0""")
def long_smoothing_events(spark, sf):
    """F5 at fixed weights, additive season of 12: one-step forecasts of all
    events as one series without a key, in chunks."""
    d = recursions.smooth_additive(_events(spark, sf), None, ["ts", "event_id"], "value", 0.3, 0.1, 0.2, 12)
    return d.select("event_id", rnd("forecast").alias("forecast"), rnd("error").alias("error"))


@register("long_innovations_events", f"""
WITH RECURSIVE {EVENTS},
r AS (SELECT 0::BIGINT AS t, NULL::BIGINT AS event_id, 0.0::DOUBLE AS y, 0.0::DOUBLE AS resid
      UNION ALL
      SELECT e.t, e.event_id, e.y, e.y - 0.5 * r.y - 0.3 * r.resid FROM r JOIN e ON e.t = r.t + 1)
SELECT event_id, round(resid, 6) AS resid FROM r WHERE t > 0""")
def long_innovations_events(spark, sf):
    """F1's recursion at fixed weights: ARMA(1, 1) innovations of all events
    as one series without a key, in chunks."""
    d = recursions.arma_innovations(_events(spark, sf), None, ["ts", "event_id"], "value", [0.5], [0.3])
    return d.select("event_id", rnd("resid").alias("resid"))

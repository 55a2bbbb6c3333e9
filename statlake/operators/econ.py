"""Project economics: cash flows, levelised cost, NPV, payback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.functions.exprs import annual_saving, monthly_rate, payback_class, payback_years
from statlake.functions.safe import div


def cash_flows(df: DataFrame, kwh: str, tariff: str, fixed_cost: float, maint: str,
               spike_month: int = 3, spike: float = 0.0, ts: str = "ts") -> DataFrame:
    """C4: revenue = kWh·tariff; costs = fixed + maintenance + a spike in
    ``spike_month``; net = revenue − costs."""
    spike_c = F.when(F.month(ts) == spike_month, F.lit(spike)).otherwise(F.lit(0.0))
    return (df.withColumn("revenue", F.col(kwh) * F.col(tariff))
              .withColumn("costs", F.lit(fixed_cost) + F.col(maint) + spike_c)
              .withColumn("net_cashflow", F.col("revenue") - F.col("costs")))


def project_summary(flows: DataFrame, keys, capex: str, kwh: str, t: str, r_annual: float = 0.08,
                    capex_every_period: bool = False) -> DataFrame:
    """C5 + C6 per project: LCOE = (capex + Σ costs)/Σ kWh and
    NPV = Σ net/(1+r_m)^t − capex, r_m = (1+r)^{1/12} − 1, t from 0.
    ``capex_every_period`` reproduces subtracting capex every month."""
    rm = monthly_rate(r_annual)
    disc = F.pow(F.lit(1.0 + rm), F.col(t))
    pv_net = F.col("net_cashflow") / disc
    pv_capex = F.col(capex) / disc if capex_every_period else F.lit(0.0)
    agg = flows.groupBy(*keys).agg(
        F.first(capex).alias(capex), F.sum("costs").alias("total_costs"), F.sum(kwh).alias("total_kwh"),
        F.sum(pv_net - pv_capex).alias("_pv"), F.count(F.lit(1)).alias("months"))
    npv = F.col("_pv") if capex_every_period else F.col("_pv") - F.col(capex)
    return agg.select(*keys, "months", capex, "total_costs", "total_kwh",
                      div(F.col(capex) + F.col("total_costs"), F.col("total_kwh")).alias("lcoe"), npv.alias("npv"))


def payback(df: DataFrame, capex: str, kwh: str, tariff: str, opex: str) -> DataFrame:
    """Annual saving, payback years (saving floored at 1e-6) and the
    class fast (0,5] / mid (5,8] / slow (8,∞); ``is_viable`` = saving > 0."""
    s = annual_saving(kwh, tariff, opex)
    return (df.withColumn("annual_saving", s)
              .withColumn("payback_years", payback_years(capex, "annual_saving"))
              .withColumn("payback_class", payback_class("payback_years"))
              .withColumn("is_viable", F.col("annual_saving") > 0))

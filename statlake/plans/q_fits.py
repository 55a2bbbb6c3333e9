"""Registered queries: nonlinear and iterative fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from statlake.functions.exprs import minmax_scale
from statlake.operators import fits, stats
from statlake.plans.common import rnd
from statlake.plans.registry import register
from statlake.sources.tables import monthly_order_totals, table


def _pv_frame(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_quantity").alias("g"), (F.col("l_extendedprice") / 1000.0).alias("p"))


@register("saturating_fit_lineitem")
def saturating_fit_lineitem(spark, sf):
    """Bounded fit P = a(1 − e^{−bG}) + c, a, b ≥ 0 (G = quantity,
    P = price/1000), start (max P, 0.005, min P); estimates, standard
    errors, RMSE and R²."""
    d = _pv_frame(spark, sf)
    st = d.agg(F.max("p").alias("mx"), F.min("p").alias("mn")).first()
    res = fits.levenberg_marquardt(d, fits.saturating, "p", ["g"], [st["mx"], 0.005, st["mn"]],
                                   lower=[0, 0, -np.inf], upper=[np.inf, np.inf, np.inf])
    rows = [(nm, float(round(v, 6)), float(round(s, 6))) for nm, v, s in zip("abc", res["theta"], res["stderr"])]
    rows += [("rmse", float(round(res["rmse"], 6)), None), ("r2", float(round(res["r2"], 6)), None)]
    return spark.createDataFrame(rows, "param string, estimate double, stderr double")


@register("exp_curve_fit_orders")
def exp_curve_fit_orders(spark, sf):
    """y = a·e^{bt} + c by Levenberg–Marquardt (λ=1e-2, ×1/3 / ×3) on
    monthly order totals (t in years from the first month, y in millions)."""
    s = monthly_order_totals(spark, sf)
    t0 = s.agg(F.min("ts")).first()[0]
    d = s.select((F.months_between("ts", F.lit(t0)) / 12.0).alias("t"), (F.col("value") / 1e6).alias("y"))
    res = fits.levenberg_marquardt(d, fits.exp_curve, "y", ["t"], [1.0, 0.1, 0.0])
    rows = [(nm, float(round(v, 6)), float(round(s_, 6))) for nm, v, s_ in zip("abc", res["theta"], res["stderr"])]
    rows += [("rmse", float(round(res["rmse"], 6)), None), ("iterations", float(res["iterations"]), None)]
    return spark.createDataFrame(rows, "param string, estimate double, stderr double")


def _lin_model(params, x):
    return params[0] + params[1] * x["l_discount"] + params[2] * x["l_tax"]


_lin_model.np = _lin_model  # the same arithmetic works on numpy arrays
_lin_model.affine = True  # in its parameters: fits read the rows once


@register("gradient_fit_lineitem")
def gradient_fit_lineitem(spark, sf):
    """M21 + M22: quantity ~ discount + tax by GD, momentum, Nesterov, Adam
    and conjugate gradients (all steps from one pass over the rows), next to OLS."""
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax")
    cols = ["l_discount", "l_tax"]
    runs = fits.gradient_fit(li, _lin_model, "l_quantity", cols, [0.0, 0.0, 0.0], max_iter=300,
                             methods={"gd": ("gd", 0.5), "momentum": ("momentum", 0.2),
                                      "nesterov": ("nesterov", 0.2), "adam": ("adam", 1.0)})
    cgs = fits.cg_fit(li, _lin_model, "l_quantity", cols, [0.0, 0.0, 0.0], rules=("fr", "pr+", "hs+", "dy"),
                      max_iter=100)
    rows = [(k, *[float(round(v, 4)) for v in th], float(round(h[-1], 4))) for k, (th, h) in runs.items()]
    rows += [(f"cg_{k}", *[float(round(v, 4)) for v in th], float(round(h[-1], 4))) for k, (th, h) in cgs.items()]
    o = {r["term"]: r["coef"] for r in stats.ols(li, "l_quantity", cols).collect()}
    rows.append(("ols", float(round(o["const"], 4)), float(round(o["l_discount"], 4)), float(round(o["l_tax"], 4)), None))
    return spark.createDataFrame(rows, "method string, b0 double, b_discount double, b_tax double, mse double")


A_FIX, B_FIX, C_FIX = 95.0, 0.02, 1.0


@register("residual_table_lineitem", f"""
SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS g, round(l_extendedprice/1000.0, 6) AS p,
       round({A_FIX}*(1.0 - exp(-{B_FIX}*l_quantity)) + {C_FIX}, 6) AS fitted,
       round(l_extendedprice/1000.0 - ({A_FIX}*(1.0 - exp(-{B_FIX}*l_quantity)) + {C_FIX}), 6) AS residual FROM lineitem""")
def residual_table_lineitem(spark, sf):
    """Fitted values and residuals of the saturating curve at fixed
    parameters, every line item."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("g"),
                                             (F.col("l_extendedprice") / 1000.0).alias("p"))
    r = fits.predict(li, fits.saturating, [A_FIX, B_FIX, C_FIX], ["g"]).withColumn("residual", F.col("p") - F.col("fitted"))
    return r.select("l_orderkey", "l_linenumber", "g", rnd("p").alias("p"), rnd("fitted").alias("fitted"),
                    rnd("residual").alias("residual"))


@register("decision_grid_lineitem", """
WITH b AS (SELECT min(l_discount) AS a0, max(l_discount) AS a1, min(l_tax) AS b0, max(l_tax) AS b1 FROM lineitem),
g AS (SELECT i, j, a0 + (a1 - a0) * i / 19 AS l_discount, b0 + (b1 - b0) * j / 19 AS l_tax FROM b, range(0, 20) t(i), range(0, 20) u(j))
SELECT i::BIGINT AS i, j::BIGINT AS j, round(l_discount, 9) AS l_discount, round(l_tax, 9) AS l_tax,
       round(25.0 + 10.0*l_discount - 5.0*l_tax, 9) AS score FROM g""")
def decision_grid_lineitem(spark, sf):
    """20×20 mesh over the discount/tax ranges scored by a fixed linear model."""
    g = fits.decision_grid(table(spark, sf, "lineitem"), ["l_discount", "l_tax"], 20,
                           lambda x: F.lit(25.0) + 10.0 * x["l_discount"] - 5.0 * x["l_tax"])
    return g.select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"),
                    rnd("l_discount", 9).alias("l_discount"), rnd("l_tax", 9).alias("l_tax"), rnd("score", 9).alias("score"))


@register("anfis_lineitem")
def anfis_lineitem(spark, sf):
    """M19 + M20: two-input first-order neuro-fuzzy regression (2 Gaussian
    memberships per input, 4 rules) of scaled quantity on scaled discount and
    tax; loss per epoch and held-out RMSE."""
    from statlake.operators.learn import stratified_split
    li = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                                             "l_returnflag", "l_quantity", "l_discount", "l_tax")
    sc = stratified_split(minmax_scale(li, ["l_quantity", "l_discount", "l_tax"]), "l_returnflag", "id", 0.2)
    train, hold = sc.filter(~F.col("is_test")), sc.filter(F.col("is_test"))
    c, s, q, hist = fits.anfis_fit(train, "l_quantity", ["l_discount", "l_tax"], n_mf=2, epochs=8, lr=0.05)
    pred = hold.withColumn("yhat", fits.anfis_predict({k: F.col(k) for k in ["l_discount", "l_tax"]},
                                                      ["l_discount", "l_tax"], c, s, q))
    rmse = pred.agg(F.sqrt(F.avg((F.col("l_quantity") - F.col("yhat")) ** 2))).first()[0]
    rows = [(i + 1, float(round(v, 6))) for i, v in enumerate(hist)] + [(0, float(round(rmse, 6)))]
    return spark.createDataFrame(rows, "epoch long, loss double")

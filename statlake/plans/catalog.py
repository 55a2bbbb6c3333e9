"""Imports every query module so its ``@register`` calls run."""

from statlake.plans import q_exprs, q_fits, q_forecast, q_learn, q_misc, q_neighbours, q_recursions, q_select, q_series, q_stats, q_trees  # noqa: F401
from statlake.plans.registry import ORACLE, QUERIES  # noqa: F401

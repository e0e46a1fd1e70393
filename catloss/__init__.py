"""Catastrophe-loss rollup on Spark DataFrames.

Reads two vendors' year loss tables (YLT) and exceedance-probability (EP)
summaries plus small seed tables, blends the vendors' EP curves into uplift
factors per return-period bucket, ranks simulated events and carries every
event loss through blending, currency conversion, forecast-date expansion,
event rate factors and rank overrides. Everything is built from DataFrame
built-ins so Catalyst and adaptive execution plan the work.
"""

from catloss.params import RunParams, TargetPoint

__all__ = ["RunParams", "TargetPoint"]

"""twosample: exact two-group hypothesis tests as Spark DataFrame plans.

Every statistic is computed on all rows with Spark aggregates, windows and
joins; results are lazy DataFrames with one row per ``by`` key.
"""
from twosample.plans.dispatch import chisquare_counts, paired, run_test, two_sample

__all__ = ["two_sample", "paired", "chisquare_counts", "run_test"]

"""Spark-native analytics for recommendation and graph-embedding workloads.

Every operator is a pure function from DataFrames to a DataFrame. Nothing in
this package keeps module state; plans stay declarative so that Catalyst and
adaptive execution choose the physical strategy.
"""

__version__ = "0.1.0"

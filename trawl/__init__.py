"""Text search and link analysis on Spark DataFrames."""

from trawl.plans.engine import Engine, ask, ordered_ids

__all__ = ["Engine", "ask", "ordered_ids"]

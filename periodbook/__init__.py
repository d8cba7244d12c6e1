"""Periodic business reviews (P&L statements and scorecards) on Spark DataFrames."""

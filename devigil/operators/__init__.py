"""Relational, text, time-series and model operators over DataFrames."""

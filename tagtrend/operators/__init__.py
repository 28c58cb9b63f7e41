"""Operators: functions from DataFrames to a DataFrame. Table and column names are parameters."""

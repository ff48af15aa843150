"""Operators: functions from keyed tables and change DataFrames to keyed tables. None of them writes."""

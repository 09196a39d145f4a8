"""Operators: functions DataFrame -> DataFrame, grouped by topic."""

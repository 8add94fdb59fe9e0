"""Operators: functions from DataFrame to DataFrame, composable with ``df.transform``."""

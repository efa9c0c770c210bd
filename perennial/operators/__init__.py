"""Operators: functions from DataFrame to DataFrame, batch and streaming alike."""

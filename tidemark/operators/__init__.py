"""The data work: functions from DataFrame to DataFrame."""

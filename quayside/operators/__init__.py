"""Operators: functions from frames to frames, and thin readers and writers."""

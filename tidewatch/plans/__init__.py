"""Whole plans: the driver tables as feeds, and one query per operator with its oracle."""

"""Operators of a training-data pipeline; each module describes its method and its edge cases."""

"""The reports, one function each, grouped by subject."""

from salesdq.operators import impute, playlist, profile, revenue, staff, timepat

__all__ = ["impute", "playlist", "profile", "revenue", "staff", "timepat"]

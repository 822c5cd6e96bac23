"""Reusable DataFrame operators: joins, rankings, roll-ups, skew handling."""

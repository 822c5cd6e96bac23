"""Registered queries, their SQL counterparts, and the bridge from the test tables."""

"""Registered queries and their SQL."""

QUERIES: dict = {}
ORACLES: dict = {}

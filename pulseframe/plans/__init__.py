"""Whole builds, and the registered queries with their SQL."""

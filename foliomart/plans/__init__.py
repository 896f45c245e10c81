"""Rollups, reports and the load sequence."""

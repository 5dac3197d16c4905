"""Dialogue-corpus preparation and audit on Spark."""

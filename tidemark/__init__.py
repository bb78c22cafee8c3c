"""Spark data platform: landed documents in, governed tables and reports out."""

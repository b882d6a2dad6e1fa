"""Curated tables from several source systems, as plain PySpark DataFrame functions."""

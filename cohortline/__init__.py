"""Longitudinal record analytics as PySpark DataFrame operators."""

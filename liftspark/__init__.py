"""Propensity scoring, lift and gain analytics as PySpark DataFrame jobs."""

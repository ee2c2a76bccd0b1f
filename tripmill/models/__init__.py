"""Spark ML estimators for trips."""

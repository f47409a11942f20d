"""Demand analytics over trips and weather, expressed as PySpark DataFrame operators."""

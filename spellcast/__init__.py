"""Propensity analytics over event history, expressed as Spark DataFrame plans."""

"""Keyed hourly time series on Spark: landing, cleaning, facts, episodes, forecasts."""

"""Behavioural feature engineering on Spark: monthly observations to model-ready rows."""

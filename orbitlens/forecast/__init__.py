"""Forecasting: series preparation, seasonality / lag discovery, features,
models, recursive forecasting and the model registry (M1-M20)."""

"""Quote-volatility features and forecasts as Spark DataFrame operators."""

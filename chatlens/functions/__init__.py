"""Column expressions: text handling, message features, lags."""

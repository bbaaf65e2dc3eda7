"""DataFrame -> DataFrame operators (profiles, targets, prep, metrics,
portfolio, backtest, models, audit)."""

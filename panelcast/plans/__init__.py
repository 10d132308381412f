"""End-to-end plans (forecast run, backtest, scoring) and the query registry."""

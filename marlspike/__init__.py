"""Market-signal analytics as Spark jobs: landing, upserts, candles, point-in-time joins, recursive features, signals, portfolios, backtests."""

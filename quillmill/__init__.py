"""Spark-native analytics over assessment items and the documents behind them."""

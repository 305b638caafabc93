"""Tidemark: windowed extraction, fleet roll-ups, work ledgers and exports as Spark DataFrames."""

"""candlewick — a PySpark library for binary event-market candles.

Reads market metadata and nested candle documents, cleans and labels them,
builds per-market window features, splits by event group, trains boosted
trees, evaluates and scores markets in batch or as a stream.
"""

__version__ = "0.1.0"

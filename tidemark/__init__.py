"""Spark-native market-data engine; the training-data operators live in ``llm``."""

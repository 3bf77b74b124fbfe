"""pagliaio: a PySpark-native analytics engine for competing, inconsistent offers.

Layout: ``sources`` (readers and parsers), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame), ``plans`` (named queries with their SQL),
``streaming`` (Structured Streaming jobs) and ``llm`` (operators for preparing
training data; nothing outside it imports it).
"""

__version__ = "0.1.0"

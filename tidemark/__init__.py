"""tidemark: market-data analytics over two trade feeds, as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function usable on batch tables
and on Structured Streaming DataFrames alike.
"""

__version__ = "0.1.0"

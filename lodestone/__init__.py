"""Analytics over source-code facts and other keyed, nested records, expressed in Spark's own operators."""

__version__ = "0.1.0"

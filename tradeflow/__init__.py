"""tradeflow: retail and wholesale analytics as Spark DataFrame reports."""

__version__ = "0.1.0"

"""Analytics over trips, sales, web pages and grids, written as Spark DataFrame operators."""

__version__ = "0.1.0"

"""usagelens: usage analytics for metered request APIs, written as Spark DataFrame plans."""

__version__ = "0.1.0"

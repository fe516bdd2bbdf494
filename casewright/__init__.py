"""Contract-driven data quality, ordinal modelling and decision operators on Spark."""

__version__ = "0.1.0"

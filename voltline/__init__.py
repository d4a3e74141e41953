"""voltline: Spark DataFrame operators for energy-market and weather time series."""

__version__ = "0.1.0"

"""Point-in-time integrity checks for event-sourced ledgers, on Spark DataFrames."""

__version__ = "0.1.0"

"""Stenograph: analytics over dated, speaker-attributed text, built on PySpark DataFrames."""

__version__ = "0.1.0"

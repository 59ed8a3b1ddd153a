"""Sequenced message streams and table movement on Spark DataFrames."""

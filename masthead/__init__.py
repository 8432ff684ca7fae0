"""Headline production and auditing over large article tables, on Spark DataFrames."""

"""Retail warehouse and KPI engine built from Spark DataFrames."""

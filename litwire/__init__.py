"""Spark-native integration of scholarly and news record feeds.

Every operator takes DataFrames or Columns and returns DataFrames or Columns.
"""

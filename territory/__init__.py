"""Territorial indicators as Spark DataFrame functions.

Every public function takes DataFrames (or Columns) and returns a lazy
DataFrame (or Column); nothing here collects rows to the driver.
"""

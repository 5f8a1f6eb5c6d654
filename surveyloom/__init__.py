"""Weighted-survey analytics expressed as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns) and starts no
job of its own unless its docstring says so.
"""

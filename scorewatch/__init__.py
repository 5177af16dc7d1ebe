"""Classifier monitoring analytics as PySpark DataFrame operators.

Every public function takes DataFrames and returns a DataFrame (or takes and returns Columns in
``scorewatch.functions``), so calls compose into one logical plan.
"""

__version__ = "0.1.0"

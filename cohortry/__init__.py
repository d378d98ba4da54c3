"""Cohort analytics on Spark.

Every operator is a plain function from DataFrames and parameters to a DataFrame. ``sources``
reads and writes clinical common-data-model tables, ``functions`` holds column expressions,
``operators`` the relational building blocks and ``plans`` whole studies.
"""

__version__ = "0.1.0"

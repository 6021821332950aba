"""quipu: tabular machine-learning data work as plain PySpark jobs.

Every operator is a function from DataFrame to DataFrame, built on Spark SQL
functions and ``pyspark.ml``.  See README.md for the map of the package.
"""

__version__ = "0.1.0"

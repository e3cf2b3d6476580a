"""custlens — Spark-native customer-value analytics.

Every capability is a function from DataFrames (plus column names and
parameters) to a DataFrame.  The heavy lifting is left to Catalyst:
aggregations, windows, joins and higher-order array functions.  Python
runs on executors only where no native operator exists (tree
contributions, PACF), and then through Arrow-batched pandas functions.
"""

__version__ = "0.1.0"

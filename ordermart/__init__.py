"""ordermart: an order-analytics pipeline (bronze -> silver -> gold) on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions; nothing runs until a sink or an action.
"""

__version__ = "0.1.0"

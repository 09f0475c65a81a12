"""ledgerline: a Spark-native retail star-schema pipeline.

Read order lines, validate them against a contract, build keyed customer,
product, location and date dimensions and an order-line fact, reconcile the
store with the source, and serve KPI marts -- all as DataFrame / Spark SQL
plans that run distributed.
"""

__version__ = "0.1.0"

"""Sources of order lines: the CSV reader and the adapter over the TPC-H-style tables."""

from .csv import csv_header, missing_columns, read_orders_csv
from .tables import read_tables_source

__all__ = ["csv_header", "missing_columns", "read_orders_csv", "read_tables_source"]

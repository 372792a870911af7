"""Reservation analytics as composable Spark DataFrame operators.

functions   column expressions: labels, codes, casts, amounts
sources     JSON lines, lookup files, rates, versioned Parquet data, JDBC
operators   DataFrame -> DataFrame steps: canonical rows, merge, history, inspection
plans       the three jobs: load reservations, sync to a relational store, maintain
"""

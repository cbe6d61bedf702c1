"""Medallion analytics over messy commercial data, written for Spark.

Raw all-string tables (Bronze) are cleaned into typed dimensions and facts
(Silver), from which the analytic outputs (Gold) and the data-quality reports
are computed.  Everything is DataFrame expressions; nothing runs in Python
workers.
"""

"""Media-engagement analytics as composable PySpark DataFrame operators.

Landed JSON payloads become typed, deduplicated silver tables, a gold star
schema, quality checks and reports. Functions take and return DataFrames; paths
appear only in ``sources`` and ``sinks``. Op ids such as F1 or D3 in docstrings
"""

"""Tidemark: a market-data warehouse and forecast-preparation library on PySpark.

Sub-packages:

* ``functions``  - Column expressions (calendar, quotes, scaling, text encodings)
* ``sources``    - message streams, archive scans, files, warehouse tables
* ``operators``  - DataFrame to DataFrame operators
* ``plans``      - the dashboard, view and forecast queries built from operators
* ``streaming``  - sinks and long-running queries
"""

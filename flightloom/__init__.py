"""Jobs for flight-recorder samples and metadata that travel as keyed JSON records.

Layout
------
``schemas``     row types of the tables, topics and results
``session``     session settings and the shared working folder
``sources``     catalog scans, topics (Kafka or parquet directory), CSV, table sinks
``functions``   the record envelope: rows to key + JSON and back
``operators``   relational and data-quality operators on DataFrames
``plans``       the batch jobs a user runs
``streaming``   incremental drain and landing of a topic
"""

"""Event-time analytics over user-behaviour tables and streams, on Spark.

Sub-packages: ``sources`` (readers and table adapters), ``functions`` (column
expressions), ``plans`` (reusable distributed plan shapes), ``operators``
(batch DataFrame operators) and ``streaming`` (Structured Streaming jobs).
"""

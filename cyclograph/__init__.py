"""Cyclograph: urban-mobility and incident analytics as PySpark DataFrame jobs.

Layers
------
``functions``  Column -> Column helpers (casts, geography, calendar, text, maths)
``sources``    landing readers, sinks and the mapping of test tables onto the domain
``operators``  reusable DataFrame -> DataFrame building blocks (distance join,
               keep-latest, ordered lag, exact quantiles, correlation, regression)
``plans``      the layered model: staging, marts, calendar, dashboards, full build
``quality``    declarative data checks and the suite runner
``streaming``  live station status with Structured Streaming
``workload``   registered queries with their SQL equivalents
"""

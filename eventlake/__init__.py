"""Spark jobs that refine geo-event messages into analytic tables and models.

Every step is a plain ``DataFrame -> DataFrame`` function; the same functions serve
static tables and Structured Streaming micro-batches.
"""

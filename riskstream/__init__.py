"""Spark-native transaction-risk engine.

``functions``  column expressions (no data movement)
``operators``  ``DataFrame -> DataFrame`` steps for ``.transform()``
``sources``    table and topic readers
``streaming``  the scoring stream, its sinks and the alert feed
``plans``      whole chains built from the above, and the driver queries
``jobs``       ``spark-submit`` entry points
"""

"""Spark-native analytics for per-entity game logs.

Every operator takes DataFrames and returns a DataFrame. Nothing here iterates over
entities on the driver; see ``operators.series`` for the way ordered features stay
balanced when one entity holds a large share of all rows.
"""

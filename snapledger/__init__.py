"""Snapshot analytics on PySpark: extract, reconcile, featurise, train, score."""

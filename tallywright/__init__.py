"""Spark jobs that compare, score and reconcile very large identity lists and record snapshots."""

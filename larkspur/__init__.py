"""Larkspur: tabular learning and document retrieval as Spark jobs."""

"""Assembled plans: warehouse, marts, queries, measures, audit and the batch run."""

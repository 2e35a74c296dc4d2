"""Compositions of the operators: the registered queries, the batch job, the dashboard."""

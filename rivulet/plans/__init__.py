"""Whole plans: log to publications, the registered queries and their SQL."""

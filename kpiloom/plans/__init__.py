"""Registered queries, their SQL twins and the batch run."""

"""Pipelines and views composed from the operators."""

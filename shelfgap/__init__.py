"""Retail assortment-gap analytics as declarative Spark DataFrame operators."""

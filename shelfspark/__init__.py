"""Supplier catalogue jobs expressed as Spark DataFrame plans."""

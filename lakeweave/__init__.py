"""Layered-lakehouse operators and jobs written with the Spark DataFrame API."""

"""Hiring-pipeline analytics expressed as Spark DataFrame operators."""

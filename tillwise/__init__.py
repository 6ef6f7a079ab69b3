"""Retail, customer and store analytics as parameterised Spark DataFrame jobs."""

"""Warehouse analytics operators for PySpark: plain ``DataFrame -> DataFrame`` functions."""

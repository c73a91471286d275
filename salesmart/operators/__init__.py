"""Warehouse operators: each is a DataFrame -> DataFrame function (no data on the driver)."""

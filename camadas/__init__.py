"""Layered (landing -> bronze -> silver -> gold) analytics on plain PySpark DataFrames."""

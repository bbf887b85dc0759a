"""Medallion tables and change-data folding as PySpark DataFrame plans."""

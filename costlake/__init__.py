"""Cloud cost and usage analytics on PySpark: layered lake, quality rules, marts, serving queries."""

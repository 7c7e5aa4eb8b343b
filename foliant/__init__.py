"""Document-collection analytics and training-data operators on PySpark."""

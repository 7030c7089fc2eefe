"""earshot: customer-feedback analytics as PySpark DataFrame jobs."""

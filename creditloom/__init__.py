"""creditloom: customer-level loan-default analytics as Spark DataFrame jobs."""

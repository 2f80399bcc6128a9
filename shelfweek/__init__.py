"""Weekly retail sales and inventory analytics as Spark DataFrame jobs."""

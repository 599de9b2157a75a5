"""Region, crop and year analytics written as Spark DataFrame jobs."""

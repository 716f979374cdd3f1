"""Company-register analytics written as Spark jobs."""

"""adloom: rental-ad pages to clean, queryable ad tables, as Spark jobs."""

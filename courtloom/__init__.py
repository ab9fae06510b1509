"""Court-docket analytics on Spark: pages in, tables, extracts and models out."""

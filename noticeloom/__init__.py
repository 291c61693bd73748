"""Notice text ETL, span annotation and dataset curation as Spark DataFrame operations."""

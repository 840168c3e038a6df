"""tidemark: incremental ingestion and reporting on PySpark."""

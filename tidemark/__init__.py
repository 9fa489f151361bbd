"""tidemark: a medallion pipeline for marketplace orders, written as Spark DataFrame jobs."""

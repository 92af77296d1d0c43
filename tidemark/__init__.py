"""tidemark: layered (bronze, silver, gold) data work on Spark tables and streams."""

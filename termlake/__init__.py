"""Text indexing and retrieval over Spark tables."""

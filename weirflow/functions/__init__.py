"""Column functions: JSON kinds and paths, topics, headers, ids, times, vectors."""

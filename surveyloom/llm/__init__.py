"""Training-data operators: documents, pages and benchmarks of a large text corpus."""

"""Reading and writing survey tables and their metadata."""

"""Reading tables and metadata, and writing results."""

"""Reading feed documents and tables."""

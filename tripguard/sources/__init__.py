"""Reading files, writing tables."""

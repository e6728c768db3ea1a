"""Reading exports and tables, and writing tables."""

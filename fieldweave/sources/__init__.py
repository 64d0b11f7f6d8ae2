"""Reading input tables and writing published lists and merged tables."""

"""Column functions: cleaning, parsing and calendar attributes."""

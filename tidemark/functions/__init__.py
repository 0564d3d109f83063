"""Column helpers used throughout the library."""

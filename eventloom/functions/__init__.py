"""Column-level functions: text, calendar parsing, cleaning, content features."""

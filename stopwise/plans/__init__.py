"""Build order of the tables, their checks and the written reports."""

"""Column helpers. Each takes and returns Columns, so all of them stay inside generated code."""

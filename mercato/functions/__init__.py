"""Column expressions and scans shared by the operators."""

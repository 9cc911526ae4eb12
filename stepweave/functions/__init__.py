"""Column functions: delimited codes and JSON."""

"""Table operations: each takes and returns DataFrames (or builds a Column)."""

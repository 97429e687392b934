"""Table jobs: every operator takes and returns DataFrames."""

"""Change logs and denylists as DataFrames."""

"""dialoom: conversation corpora as DataFrames."""

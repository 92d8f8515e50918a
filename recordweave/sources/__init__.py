"""Source contracts, delimited files and entity tables."""

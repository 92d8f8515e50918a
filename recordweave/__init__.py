"""Record consolidation on Spark: standardise, quarantine, dedupe, merge, profile, load."""

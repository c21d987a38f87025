"""Table builders, reports and the pipeline."""

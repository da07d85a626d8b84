"""DataFrame transforms of the pipeline."""

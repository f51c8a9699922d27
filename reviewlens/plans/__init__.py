"""Complete jobs: what a user of the engine calls."""

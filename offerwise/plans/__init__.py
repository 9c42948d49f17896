"""User-level jobs, each a composition of the operators."""

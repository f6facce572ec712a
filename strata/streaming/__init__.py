"""streaming of the strata library."""

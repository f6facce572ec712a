"""operators of the strata library."""

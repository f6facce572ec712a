"""sources of the strata library."""

"""functions of the strata library."""

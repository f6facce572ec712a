"""plans of the strata library."""

"""Every job on the shared test tables, and the same results in plain SQL."""

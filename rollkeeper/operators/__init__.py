"""Set operators; every one takes column names, so it serves any keyed table."""

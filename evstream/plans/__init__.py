"""Ready analytics jobs, and the named queries that run them on the test tables."""

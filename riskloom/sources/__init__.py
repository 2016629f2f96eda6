"""Files and stored tables."""

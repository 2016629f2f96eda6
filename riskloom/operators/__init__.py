"""DataFrame -> DataFrame operators; column names are arguments throughout."""

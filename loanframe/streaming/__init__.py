"""The row-wise operators applied to an unbounded loan table."""

"""Operators that move rows between partitions, DataFrame in and DataFrame out."""

"""DataFrame operators: spatial joins, cleaning, contracts, merge, reports."""

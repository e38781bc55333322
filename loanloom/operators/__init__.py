"""DataFrame operators and fitted transforms."""

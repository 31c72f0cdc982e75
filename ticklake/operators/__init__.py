"""DataFrame-to-DataFrame operators on ticks."""

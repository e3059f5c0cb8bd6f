"""DataFrame-to-DataFrame operators: no path, no clock, no action inside."""

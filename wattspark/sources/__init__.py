"""Table, file and stream sources, and the sinks that write them."""

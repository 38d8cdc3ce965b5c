"""Jobs a user runs: compositions of operators with a source and a sink."""

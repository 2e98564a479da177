"""Sales, logistics, ABC and profiling reports."""

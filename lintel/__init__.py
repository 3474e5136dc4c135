"""Feature preparation, profiling, evaluation and audit of labelled tables on Spark."""

"""The three layers as pure DataFrame functions, and the runs that store their results."""

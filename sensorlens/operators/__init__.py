"""DataFrame-in, DataFrame-out operators, grouped by the step of the work they serve."""

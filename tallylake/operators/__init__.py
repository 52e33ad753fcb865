"""DataFrame-in, DataFrame-out operators. None of them runs a job by itself
unless its docstring says so."""

"""Results built from the operators: marts, report tables, history, the batch run."""

"""Column builders: every function takes and returns Columns, none runs a job."""

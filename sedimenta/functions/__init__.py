"""Column-level building blocks; all of them compile to built-in expressions."""

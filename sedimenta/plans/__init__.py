"""Layer plans: what each table of each layer is made of, and how it is run."""

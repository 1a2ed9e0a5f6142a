"""Reading the registry tables and writing results."""

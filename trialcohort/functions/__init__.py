"""Column expressions. Nothing here reads data or needs a session."""

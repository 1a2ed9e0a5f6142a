"""DataFrames in, DataFrame out. No function here runs a job or uses Python per row."""

"""Who takes part in clinical trials: registry tables in, one row per trial out, on Spark DataFrames."""

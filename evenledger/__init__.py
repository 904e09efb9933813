"""Result reconciliation and statement-corpus profiling on Spark DataFrames."""

"""Column functions: Column in, Column out, all built from Spark SQL built-ins."""

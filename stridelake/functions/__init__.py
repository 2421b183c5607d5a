"""Column functions: all are Spark expressions unless their module says otherwise."""

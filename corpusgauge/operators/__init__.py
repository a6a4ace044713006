"""Table operators: DataFrames in, one lazily planned DataFrame out."""

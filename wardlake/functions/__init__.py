"""Column expressions: every function takes and returns Spark columns, so plans stay in codegen."""

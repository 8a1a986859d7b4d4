"""Column functions: no joins, no shuffles, all inside code generation where Spark allows."""

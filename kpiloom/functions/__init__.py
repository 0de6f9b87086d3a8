"""Column expressions and parameter checks shared by the operators."""

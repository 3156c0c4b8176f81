"""Table operators, grouped by kind."""

"""Column expressions: predicates, text rules, parsing, formatting, arrays, aggregates."""

"""Column expressions: text, numbers, time, vehicles, factors, streets, ids, geometry."""

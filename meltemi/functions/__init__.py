"""Column factories: everything here stays inside whole-stage code generation."""

"""Column expressions shared by the operators: text, time and number helpers."""

"""Column expressions: no Python runs inside the executors' row loop."""

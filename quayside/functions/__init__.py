"""Column expressions and small frame helpers."""

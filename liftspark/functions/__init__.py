"""Column expressions and small frame-to-frame helpers."""

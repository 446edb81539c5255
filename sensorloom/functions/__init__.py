"""Column expressions and the numpy kernels that run inside tasks."""

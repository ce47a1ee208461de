"""Row-wise Column expressions."""

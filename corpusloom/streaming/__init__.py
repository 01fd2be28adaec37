"""Row-wise scoring and tagging on streams."""

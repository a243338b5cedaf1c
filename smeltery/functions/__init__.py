"""Column expressions: no action, no shuffle, usable in batch and on streams."""

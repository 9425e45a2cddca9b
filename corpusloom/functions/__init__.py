"""Row-local Column expressions: no shuffle, no Python workers."""

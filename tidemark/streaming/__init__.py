"""Following a source: the loop, what wakes it, and what it reports."""

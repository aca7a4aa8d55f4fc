"""Training-data operators; nothing else in the package imports this one."""

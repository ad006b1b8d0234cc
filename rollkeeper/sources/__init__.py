"""Reading and writing: feed files, stamped history, target tables."""

"""Reading and writing: snapshots, product tables, histories, message streams."""

"""Reading and writing: source files, layer folders, views and ad-hoc SQL."""

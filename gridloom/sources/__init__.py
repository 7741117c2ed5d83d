"""Reading and writing tables, files and stores."""

"""Reading and writing clinical tables, concept files and study results."""

"""Whole workflows, chained from the operators. Column names are snake_case throughout;
``sources.edge`` renames tables from and to their published headings."""

"""Relational operators: grouping, paging, window rules, chunking, refresh decisions, graphs, validation, tree edits."""

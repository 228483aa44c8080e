"""Operators for building and cleaning large text corpora.  Nothing else in the package imports this one."""

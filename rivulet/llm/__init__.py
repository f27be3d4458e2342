"""Operators for preparing large text corpora.  Nothing else in rivulet imports this package."""

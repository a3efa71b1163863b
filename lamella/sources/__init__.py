"""Readers and writers of stacks, feature sets, models and tables."""

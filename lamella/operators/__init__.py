"""Relational operators on voxels, labels, overlaps, merges and graphs."""

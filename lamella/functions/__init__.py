"""Scalar expressions: worths, packing, colours, affinities, text helpers."""

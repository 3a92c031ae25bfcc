"""Operators by inventory group: variants (B), intervals (C), divergent (D), haplotypes (E), alignment (F), pca (G)."""

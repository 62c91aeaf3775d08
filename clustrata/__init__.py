"""Finding and characterising subgroups in samples x features cohorts, on Spark DataFrames.

Matrices are long tables ``(sample, gene, value)``; nothing ever has one column per gene.
"""

"""Operations on text corpora, embeddings and token files for training-data preparation.

Nothing else in the library imports this package.
"""

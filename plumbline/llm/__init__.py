"""Operations on text corpora for language-model training, each a Spark job of its own.

Nothing else in the package imports this subpackage.
"""

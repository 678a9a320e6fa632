"""Operators for building training corpora.

Thirteen operators (near-duplicate search, archives, personal data, classifiers,
language identification, decontamination, mixing, language-model scoring,
conversation repair, hard negatives, packing),
one module each. Nothing else in the package imports this subpackage.
"""

"""Operators over text corpora: duplicates, quality, secrets, languages, mixing, packing and chat logs.

Nothing else in the library imports this package.
"""

"""Operators over DataFrames of documents, pages, sections, candidates and annotations."""

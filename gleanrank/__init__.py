"""Domain corpus building and ranked retrieval as PySpark DataFrame jobs."""

from gleanrank.plans.corpus import build_corpus
from gleanrank.plans.extract import extract_domain
from gleanrank.plans.index import build_index
from gleanrank.plans.search import search, search_documents

__all__ = ["build_corpus", "build_index", "extract_domain", "search", "search_documents"]

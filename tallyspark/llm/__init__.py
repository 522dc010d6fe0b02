"""Operators for preparing training data: extraction, URL rules, quality,
tokens, chat text, near duplicates, packing, line dedup, vector search,
toxicity, quality, periodic runs and a trie of conversations.  Nothing else in the library imports this subpackage."""

"""Operators of a training-data pipeline: URL filters, n-gram join, source
mixing, WARC fixity, quality ledger, language ID, HTML extraction, personal
data, byte-level BPE, embedding near-duplicates, conversation prefix trie, ranked
lexical search and exact top-k search. Nothing else in the
library imports this subpackage."""

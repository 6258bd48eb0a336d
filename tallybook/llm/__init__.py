"""Training-data operators: deduplication, quality, toxicity, extraction, mixing, PII, secrets.

Each module holds one operator with a general interface; ``queries`` holds the
registered ``opN_<name>`` queries.  Nothing outside this package imports it.
"""

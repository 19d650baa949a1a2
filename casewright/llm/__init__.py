"""Training-data operators: extraction, packing, search, formatting, classification and deduplication.

Nothing outside this subpackage imports it; ``casewright.llm.queries`` lists its queries.
"""

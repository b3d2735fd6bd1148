"""Operations of a training-data pipeline: deduplication, search, scoring, packing and mixing.

Nothing outside this folder imports it; the registered queries are in `catalogue`.
"""

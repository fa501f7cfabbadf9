"""Training-data operators over text tables (documents, pages, benchmark).

Nothing outside this subpackage imports it; its queries are registered by
``orbitlens.llm.queries`` and by ``corpus_pipeline.py``.
"""

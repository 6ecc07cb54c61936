"""Training-data operators: dedup, decontamination, search, archives, PII,
packing, token counts, toxicity and sharding.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the
registered queries are in ``faclake.llm.queries``.
"""

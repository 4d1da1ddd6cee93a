"""Training-data pipeline operators (dedup, decontamination, filters, packing).

Nothing outside this subpackage imports it; its queries live in ``touchline.llm.queries``.
"""

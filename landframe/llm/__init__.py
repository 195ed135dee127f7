"""Training-data operators: sharding, token counts, packing, license and secret scans,
quality rules, PII surrogates, near-duplicate join, decontamination and toxicity.

Nothing outside this subpackage imports it.  Every operator is DataFrame in / DataFrame
out; ``queries`` registers one query per operator over the driver's tables.
"""

"""Training-data operators: token counts, decontamination, sharding, dedup, archives, scoring, mixing, secrets.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` registers
its queries when it is present.
"""

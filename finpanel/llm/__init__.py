"""Training-data operators: dedup, decontamination, mixing, scoring, scans, language ID.

Each module holds one operator with its own interface; ``catalog`` registers the thin
``opN_<name>`` queries over the driver tables and their DuckDB oracles.
"""

"""Training-data operators: near-duplicate search, cleaning, scoring, mixing, formatting
and packing of text tables.

Each module holds one operator with its own general interface. ``queries`` registers
one query per operator and its DuckDB SQL where SQL can express it. Nothing outside this
subpackage (and the top-level pipeline) imports it.
"""

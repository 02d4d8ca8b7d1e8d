"""Column rules: text (split, NULL markers, picking, escaping, typing,
charsets), dates (dialect text, trial-format parsing) and names (shards,
braces, date macros, routing)."""

"""Column-to-Column building blocks: patterns, span algebra, generators, text helpers."""

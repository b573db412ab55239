"""Column-level helpers: pandas-compatible null/rounding/ranking semantics and schemas."""

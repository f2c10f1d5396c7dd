"""Table builders (cleaning) and result tables (reports)."""

"""DataFrame-level operators (shingling, comparison, reports, revisions, runtime)."""

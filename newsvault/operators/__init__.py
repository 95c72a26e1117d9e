"""DataFrame operators: staging, vault, merge, marts, control, enrichment, quality."""

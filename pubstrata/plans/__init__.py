"""Query registry, SQL oracle, stage configuration and stage tables."""

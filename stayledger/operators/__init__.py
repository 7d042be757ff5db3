"""DataFrame operators: transform chain, quality reports, versioned table, copies."""

"""Query catalogue: table adapters, registered queries and their SQL counterparts."""

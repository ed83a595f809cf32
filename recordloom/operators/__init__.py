"""DataFrame operators: extraction, quality rules, ledger, cleaning."""

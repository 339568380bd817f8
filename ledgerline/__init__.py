"""ledgerline: retail ledger analytics expressed as Spark DataFrame plans."""

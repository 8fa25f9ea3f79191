"""lotloom: filing-ledger analytics expressed as Spark DataFrame plans."""

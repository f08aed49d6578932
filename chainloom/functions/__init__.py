"""Column functions: numbers in hexadecimal text, and small rules of the ledger."""

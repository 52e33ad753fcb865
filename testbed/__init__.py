"""The given tables as the five sources, the registered queries and their SQL oracles."""

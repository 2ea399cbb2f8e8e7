"""Registered queries: the library run over the given tables, each with an independent SQL text where SQL can say it."""

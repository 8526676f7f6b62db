"""The operators over spans that keep arriving."""

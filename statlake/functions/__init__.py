"""Column-expression builders and vectorised distribution tails."""

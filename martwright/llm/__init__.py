"""Training-data operators (text, tokens, search, scoring). Nothing outside this subpackage imports it."""

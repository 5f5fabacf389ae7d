"""Column functions: text, phonetics, folding, fuzzy ratios, sets and vectors."""

"""Column expressions: text cleaning, rule folding, money, hashing."""

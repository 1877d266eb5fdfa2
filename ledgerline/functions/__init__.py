"""Column functions: text cleaning, money and dates."""

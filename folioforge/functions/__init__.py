"""Column functions: text cleaning, entities, markup, paths and dates."""

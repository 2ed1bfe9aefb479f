"""Operators: cleaning, fact, dimensions, marts, running totals, partials, skew and quality."""

"""Operators for preparing training text, each with its own module; ``queries`` registers them."""

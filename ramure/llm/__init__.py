"""Operators on training text for language models; nothing else in the library imports them."""

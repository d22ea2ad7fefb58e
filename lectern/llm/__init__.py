"""Operators for preparing training text: ten dealt methods, each in a module of its own."""

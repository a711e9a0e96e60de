"""Preparation of language-model training text: one module per operator, their queries in ``queries``."""

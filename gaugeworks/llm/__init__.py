"""Operators for preparing training text at scale.

Each module holds one operator with a general interface; ``queries`` applies them to whole tables.
"""

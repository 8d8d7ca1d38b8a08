"""Operators for preparing training text: each module holds one operator, ``queries`` the registered queries."""

"""Operators for preparing training text at cluster scale.

Nothing else in the library imports this subpackage; ``queries`` registers its
operators under the names ``opN_<name>``.
"""

"""Operators for preparing training data at corpus scale.

Each module holds one operator; ``queries.py`` registers them.  Nothing outside
this subpackage imports it, so it can be removed as a whole.
"""

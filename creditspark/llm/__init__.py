"""Training-data operators. Nothing else in the library imports this subpackage.

Each operator module has a general function over any DataFrame; ``queries`` holds the thin
registered queries that apply them to the tables of a data folder.
"""

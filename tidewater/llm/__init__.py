"""Training-data operators (one module each) and their registered queries.

Nothing else in the library imports this subpackage; ``queries`` and
``oracles`` here are added to the driver contract when it can be imported.
"""

"""Training-data operators. Nothing else in the library imports this package.

One module per operator; ``queries`` registers the query of each. The package is
independent of the rest except for the shared-folder helper in ``session``.
"""

from .queries import QUERIES, SQL


def registry() -> dict:
    return dict(QUERIES)


def oracle() -> dict:
    return dict(SQL)

"""corate: user-based collaborative filtering as Spark DataFrame operators.

Subpackages: ``functions`` (column expressions), ``operators`` (ratings,
blocks for hot keys, pairs, neighbours, prediction, evaluation, capacity,
recommendation, personal ratings, checks), ``sources`` (files, report sink,
test-table view) and ``plans`` (reports and registered queries).
"""

__version__ = "0.1.0"

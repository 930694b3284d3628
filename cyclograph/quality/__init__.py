"""Declarative data checks.

A check is a callable: ``check(df)`` returns the bad rows, and no rows means it passed.
Checks on rows and plain aggregates also carry a counter expression, so that a suite
evaluates all of them in one pass over the table (``suite.run``).

NULLs follow three-valued logic: an expression that is NULL passes, whereas membership
checks (value in set) fail on NULL.
"""

from cyclograph.quality.aggregates import *  # noqa: F401,F403
from cyclograph.quality.core import Check, expression_between, expression_is_true, equal_expression  # noqa: F401
from cyclograph.quality.distribution import *  # noqa: F401,F403
from cyclograph.quality.multicolumn import *  # noqa: F401,F403
from cyclograph.quality.shape import *  # noqa: F401,F403
from cyclograph.quality.strings import *  # noqa: F401,F403
from cyclograph.quality.values import *  # noqa: F401,F403

"""Operators of a training-data pipeline: language, licence, duplicate, quality, tokenizer, chat, HTML and packing jobs.

Nothing else in the library imports this package. Its functions travel inside the tasks, so workers
need no installed copy.
"""

import sys

from rosterlake import session

session.ship_with_tasks(sys.modules[__name__])
session.ship_with_tasks(session)  # the helpers of the operators name its functions

from fieldmart.functions.expressions import *  # noqa: F401,F403
from fieldmart.functions.aggregates import *  # noqa: F401,F403

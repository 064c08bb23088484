"""Column builders: every function takes and returns Spark columns."""

from .features import *  # noqa: F401,F403
from .hashing import *  # noqa: F401,F403
from .labels import *  # noqa: F401,F403
from .measures import *  # noqa: F401,F403

"""Column functions; everything here stays inside Spark's JVM expressions."""

from cuelake.functions.cues import *  # noqa: F401,F403
from cuelake.functions.hashing import *  # noqa: F401,F403
from cuelake.functions.text import *  # noqa: F401,F403
from cuelake.functions.times import *  # noqa: F401,F403

"""Analytics on large directed graphs given as edge tables, as Spark DataFrame operators."""

from edgeflow.operators import *  # noqa: F401,F403
from edgeflow.session import get_session  # noqa: F401
from edgeflow.sinks import *  # noqa: F401,F403
from edgeflow.sources import *  # noqa: F401,F403

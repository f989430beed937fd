"""Preparation of code-mixed text corpora on Spark."""

from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .plans import build_dataset, prepare  # noqa: F401
from .sources import *  # noqa: F401,F403

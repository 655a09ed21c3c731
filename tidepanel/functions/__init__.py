"""Column functions: scalar helpers and driver-side distribution tails."""
from .scalar import *  # noqa: F401,F403

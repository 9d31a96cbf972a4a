from hopweave.functions.common import *  # noqa: F401,F403

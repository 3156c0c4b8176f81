from panelkit.functions.dates import *  # noqa: F401,F403
from panelkit.functions.text import *  # noqa: F401,F403

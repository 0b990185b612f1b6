"""Column -> Column cleaners (strings, dates, numbers, booleans). No UDFs."""

from orderlake.functions.text import *  # noqa: F401,F403
from orderlake.functions.dates import *  # noqa: F401,F403
from orderlake.functions.numbers import *  # noqa: F401,F403

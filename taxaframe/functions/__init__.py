"""Column-expression functions (string, array, math) used by the operators."""

from taxaframe.functions.lineage import *  # noqa: F401,F403
from taxaframe.functions.sequence import *  # noqa: F401,F403

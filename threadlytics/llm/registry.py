"""Names of the corpus queries and of their SQL."""

from threadlytics.llm import queries
from threadlytics.llm.oracle import ORACLE  # noqa: F401

QUERIES = {
    name: getattr(queries, name)
    for name in sorted(vars(queries), key=lambda n: (len(n.split("_")[0]), n))
    if name.startswith("op") and name[2].isdigit()
}

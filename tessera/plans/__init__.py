"""Query plans.  Importing this package registers every query."""

from tessera.plans import documents, extras, names, relational, vectors  # noqa: F401
from tessera.plans import io, stream  # noqa: F401,I001  (io reuses oracles registered above)
from tessera.plans.registry import ORACLES, QUERIES  # noqa: F401

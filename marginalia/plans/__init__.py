"""Named queries and their SQL oracle text.

Importing this package registers every query in ``catalog.QUERIES``.
"""

from marginalia.plans import catalog  # noqa: F401
from marginalia.plans import commerce  # noqa: F401
from marginalia.plans import marketing  # noqa: F401
from marginalia.plans import finance  # noqa: F401
from marginalia.plans import search  # noqa: F401
from marginalia.plans import seo  # noqa: F401
from marginalia.plans import serving  # noqa: F401
from marginalia.plans import marketplace  # noqa: F401
from marginalia.plans import tables  # noqa: F401
from marginalia.plans import landing  # noqa: F401
from marginalia.plans import feeds  # noqa: F401
from marginalia.plans import staging  # noqa: F401
from marginalia.plans import shaped  # noqa: F401

QUERIES = catalog.QUERIES

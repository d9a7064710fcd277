"""URL functions: netloc (F10) and link resolution.

Resolution runs natively for absolute, protocol-relative and root-relative links
without dot segments; only the remaining relative forms go through Python
(urllib.parse.urljoin, Arrow-batched), and they get null arguments otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def netloc(url) -> Column:
    """authority part (user info and port included); '' when there is none."""
    return F.regexp_extract(_col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def origin(url) -> Column:
    return F.regexp_extract(_col(url), _ORIGIN, 1)


@F.pandas_udf(T.StringType())
def _urljoin(base: pd.Series, href: pd.Series) -> pd.Series:
    from urllib.parse import urljoin
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href)], dtype=object)


def resolve_link(base, href) -> Column:
    """urljoin(base, href)."""
    b, h = _col(base), _col(href)
    dot = h.rlike(r"(^|/)\.\.?(/|$|[?#])")
    absolute = h.rlike(_SCHEME)
    proto_rel = h.startswith("//")
    root_rel = h.startswith("/") & ~proto_rel & ~dot & (origin(b) != "")
    fast = (F.when(absolute & ~dot, h)
            .when(proto_rel & ~dot & b.rlike(_SCHEME), F.concat(F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), h))
            .when(root_rel, F.concat(origin(b), h)))
    slow = F.when(fast.isNull() & h.isNotNull(), h)
    return F.coalesce(fast, _urljoin(F.when(slow.isNotNull(), b), slow))

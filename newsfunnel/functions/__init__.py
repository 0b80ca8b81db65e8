"""Column-expression helpers shared by the operators (all JVM-side, no UDFs)."""

from newsfunnel.functions.text import (  # noqa: F401
    PY_SPACE,
    WORD,
    java_regex_literal,
    pystrip,
    slugify,
)
from newsfunnel.functions.urls import normalize_url, quote_plus, url_host  # noqa: F401

"""Column naming rules, applied to schema names while a plan is built."""

from __future__ import annotations

import re
import unicodedata


def initials(name: str) -> str:
    """First letters of a snake, kebab or camel name: ``formacao_e_idiomas`` -> ``fei``."""
    words = re.split(r"[\s_-]+|(?=[A-Z])", name)
    return "".join(w[0] for w in words if w).lower()


def tidy_name(name: str) -> str:
    """ASCII, lower case, single underscores, none at the ends."""
    ascii_only = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"_{2,}", "_", re.sub(r"\W|\s+", "_", ascii_only)).strip("_").lower()

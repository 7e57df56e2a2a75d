"""Masking of secrets in any text column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mask, the shortest secret worth matching, and the client properties that hold
# credentials, whose value is masked even when it is not a known secret.
MASK = "***"
SHORTEST_SECRET = 3
PASSWORD_PROPERTIES = (
    "sasl.password",
    "ssl.key.password",
    "ssl.keystore.password",
    "sasl.oauthbearer.client.secret",
)

_NAMES = "|".join(p.replace(".", r"\.") for p in PASSWORD_PROPERTIES)
# Word boundary and white space in the Unicode sense, by (?U).
PROPERTY_PATTERN = rf'(?U)\b({_NAMES})=(?:"[^"]*"|[^\s;,]+)'


def usable_secrets(secrets: Iterable[str]) -> list[str]:
    """Distinct, long enough, longest first, so a secret inside another cannot leave its rest behind."""
    return sorted({s for s in secrets if len(s) >= SHORTEST_SECRET}, key=lambda s: (-len(s), s))


def redact_values(text: Column, secrets: Iterable[str]) -> Column:
    """Replace every occurrence of each known secret."""
    for secret in usable_secrets(secrets):
        text = F.replace(text, F.lit(secret), F.lit(MASK))
    return text


def redact_properties(text: Column) -> Column:
    """Mask the value of password properties, as ``key=value`` or ``key="quoted value"``."""
    return F.regexp_replace(text, PROPERTY_PATTERN, f"$1={MASK}")


def redact(text: Column, secrets: Iterable[str] = ()) -> Column:
    return redact_properties(redact_values(text, secrets))

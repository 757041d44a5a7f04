"""Masks for personal data, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from innlake.constants import (
    EMAIL_MASK_PATTERN,
    EMAIL_MASK_REPLACEMENT,
    PHONE_MASK_PREFIX,
    PHONE_VISIBLE_DIGITS,
    PRIVILEGED_ROLE,
)


def mask_email(email: Column, role: str, strict: bool = False) -> Column:
    """First two characters and the domain stay readable.

    The default leaves an address with a local part of two characters or fewer
    as it is; ``strict=True`` hides everything before the last ``@``.
    """
    if role == PRIVILEGED_ROLE:
        return email
    if strict:
        return F.concat(F.lit("***@"), F.substring_index(email, "@", -1))
    return F.regexp_replace(email, F.lit(EMAIL_MASK_PATTERN), F.lit(EMAIL_MASK_REPLACEMENT))


def mask_phone(phone: Column, role: str) -> Column:
    if role == PRIVILEGED_ROLE:
        return phone
    return F.concat(F.lit(PHONE_MASK_PREFIX), F.right(phone, F.lit(PHONE_VISIBLE_DIGITS)))

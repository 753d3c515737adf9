"""E-mail and web-domain keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import WEBMAIL_DOMAINS
from .text import ColumnLike, as_col, blank_to_null, clean, strip


def email_key(c: ColumnLike) -> Column:
    return clean(F.lower(as_col(c)))


def email_domain(c: ColumnLike) -> Column:
    """Domain of a company address; webmail identifies no company."""
    domain = blank_to_null(strip(F.lower(F.split_part(as_col(c), F.lit("@"), F.lit(2)))))
    return F.when(~domain.isin(WEBMAIL_DOMAINS), domain)


def url_host(c: ColumnLike) -> Column:
    """Host of a URL with or without scheme; www. cut, other subdomains and port kept."""
    authority = F.regexp_extract(strip(F.lower(as_col(c))), r"^(?:https?://)?([^/?#]+)", 1)
    host = F.regexp_replace(authority, r"^www\.", "")
    return F.when(authority.contains("."), blank_to_null(host))


def root_domain(c: ColumnLike) -> Column:
    """Last two labels of the host."""
    host = F.regexp_extract(
        strip(F.lower(as_col(c))), r"^(?:https?://)?(?:www\.)?([^/:]*)", 1
    )
    labels = F.split(host, r"\.")
    return blank_to_null(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))


def loose_domain(c: ColumnLike) -> Column:
    """Scheme and www. removed wherever they stand, then path and port cut."""
    bare = F.regexp_replace(as_col(c), r"http://|https://", "")
    bare = F.regexp_replace(bare, r"www\.", "")
    return clean(F.lower(F.regexp_extract(bare, r"^([^/:]*)", 1)))


def guessed_mailbox(domain: ColumnLike) -> Column:
    return F.concat(F.lit("info@"), as_col(domain))


def mail_suffix(domain: ColumnLike) -> Column:
    return F.concat(F.lit("@"), as_col(domain))

"""SQL text of the normalisers for the checks, written independently of the Spark columns."""

from __future__ import annotations

from ..functions import fixed_values as fixed


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def squeeze(x: str) -> str:
    spaces = rf"regexp_replace({x}, '\s+', ' ', 'g')"
    return strip(spaces)


def clean(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def digits(x: str) -> str:
    return f"nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


def phone10(x: str) -> str:
    d = digits(x)
    return (
        f"(CASE WHEN length({d}) = 10 THEN {d} "
        f"WHEN length({d}) = 11 AND {d} LIKE '1%' THEN substr({d}, 2) END)"
    )


def toll_free(p: str) -> str:
    return f"coalesce(substr({p}, 1, 3) IN ({quoted(fixed.TOLL_FREE_PREFIXES)}), false)"


def _literal(text: str) -> str:
    special = ".&/"
    return "".join("\\" + ch if ch in special else ch for ch in text)


def endings_off(x: str, endings: list[str]) -> str:
    for e in endings:
        x = f"regexp_replace({x}, '{_literal(e)}\\z', '')"
    return x


def no_punctuation(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"


def company_key(x: str, endings: list[str] = fixed.LEGAL_SUFFIXES) -> str:
    return f"nullif({squeeze(no_punctuation(endings_off(strip(f'lower({x})'), endings)))}, '')"


def patterns_off(x: str, patterns: list[str]) -> str:
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


def company_key_upper(x: str) -> str:
    return f"nullif({squeeze(patterns_off(f'upper({strip(x)})', fixed.UPPER_SUFFIX_PATTERNS))}, '')"


def company_key_anchored(x: str) -> str:
    return (
        f"nullif({squeeze(patterns_off(strip(f'lower({x})'), fixed.ANCHORED_SUFFIX_PATTERNS))}, '')"
    )


def company_key_cut(x: str, pieces: list[str] = fixed.CUT_ANYWHERE) -> str:
    x = strip(f"lower({x})")
    for p in pieces:
        x = f"replace({x}, '{p}', '')"
    return f"nullif({squeeze(no_punctuation(x))}, '')"


def email_key(x: str) -> str:
    return f"nullif({strip(f'lower({x})')}, '')"


def email_domain(x: str) -> str:
    d = f"nullif({strip(f'''lower(split_part({x}, '@', 2))''')}, '')"
    return f"(CASE WHEN {d} NOT IN ({quoted(fixed.WEBMAIL_DOMAINS)}) THEN {d} END)"


def url_host(x: str) -> str:
    bare = rf"regexp_replace({strip(f'lower({x})')}, '^https?://', '')"
    host = rf"regexp_replace(regexp_extract({bare}, '^[^/?#]+', 0), '^www\.', '')"
    return f"(CASE WHEN contains(regexp_extract({bare}, '^[^/?#]+', 0), '.') THEN nullif({host}, '') END)"


def root_domain(x: str) -> str:
    bare = rf"regexp_replace(regexp_replace({strip(f'lower({x})')}, '^https?://', ''), '^www\.', '')"
    host = f"split_part(split_part({bare}, '/', 1), ':', 1)"
    return rf"nullif(regexp_extract({host}, '[^.]*(\.[^.]*)?$', 0), '')"


def loose_domain(x: str) -> str:
    bare = f"replace(replace(replace({x}, 'http://', ''), 'https://', ''), 'www.', '')"
    return f"nullif({strip(f'''lower(split_part(split_part({bare}, '/', 1), ':', 1))''')}, '')"


def has_any(x: str, words: list[str]) -> str:
    tests = " OR ".join(f"contains(lower({x}), '{w}')" for w in words)
    return f"coalesce({tests}, false)"


def found(x: str, words: list[str]) -> str:
    return f"list_filter([{quoted(words)}], lambda w: contains(lower({x}), w))"


def mapped(x: str, table: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"(CASE {x} {arms} END)"


def tier(score: str, scale: int = 1) -> str:
    return (
        f"(CASE WHEN {score} >= {80 * scale} THEN 'PLATINUM' WHEN {score} >= {60 * scale} THEN 'GOLD' "
        f"WHEN {score} >= {40 * scale} THEN 'SILVER' ELSE 'BRONZE' END)"
    )


def div_half_up(n: str, d: str) -> str:
    return f"(CAST((({n}) * 2 + ({d})) AS BIGINT) // nullif(CAST(({d}) * 2 AS BIGINT), 0))"


def percent(part: str, whole: str, digits: int = 1) -> str:
    scale = 10**digits
    return f"({div_half_up(f'({part}) * {100 * scale}', whole)} / {scale}.0::DOUBLE)"


# Matching blocks of `pairs` (pair, a, b): the longest common run of a range, the first in a and then in b of
# equally long ones, then the ranges before and behind it. ratio is twice the matched letters by all letters.
BLOCK_RATIOS = """letters AS (
        SELECT pair, i, j FROM (SELECT pair, a, b, i, unnest(range(1, length(b) + 1)) AS j
            FROM (SELECT pair, a, b, unnest(range(1, length(a) + 1)) AS i FROM pairs)) WHERE a[i] = b[j]),
    runs AS (
        SELECT pair, i, j, count(*) OVER (PARTITION BY pair, i - j, island ORDER BY i DESC) AS run
        FROM (SELECT *, i - row_number() OVER (PARTITION BY pair, i - j ORDER BY i) AS island FROM letters)),
    parts AS (
        SELECT pair, CAST(1 AS BIGINT) AS alo, length(a) + 1 AS ahi, CAST(1 AS BIGINT) AS blo, length(b) + 1 AS bhi,
            CAST(0 AS BIGINT) AS matched FROM pairs
        UNION ALL
        SELECT pair, unnest([alo, i + size]), unnest([i, ahi]), unnest([blo, j + size]), unnest([j, bhi]),
            unnest([size, CAST(0 AS BIGINT)])
        FROM (SELECT pair, alo, ahi, blo, bhi, best.size AS size, -best.i AS i, -best.j AS j
            FROM (SELECT parts.pair, alo, ahi, blo, bhi,
                    max({'size': least(run, ahi - i, bhi - j), 'i': -i, 'j': -j}) AS best
                FROM parts JOIN runs ON runs.pair = parts.pair AND i >= alo AND i < ahi AND j >= blo AND j < bhi
                GROUP BY ALL))),
    ratios AS (
        SELECT a, b, CAST(2 AS DOUBLE) * CAST(sum(matched) AS BIGINT) / (length(a) + length(b)) AS ratio
        FROM parts JOIN pairs USING (pair) GROUP BY a, b)"""


# One row of the dynamic programme per letter of first_key: the letter's matches in name_key come
# in as a list of 0 and 1, and the row is the running maximum of what each match allows.
LCS = """list_last(list_reduce(list_prepend(
        list_transform(range(1, length(name_key) + 1), lambda i: 0),
        list_transform(range(1, length(first_key) + 1), lambda k: list_transform(
            range(1, length(name_key) + 1), lambda i: CAST(name_key[i] = first_key[k] AS INT)))),
    lambda row, hit: list_transform(range(1, len(hit) + 1), lambda i: list_max(list_transform(
        range(1, i + 1), lambda j: CASE WHEN hit[j] = 1 THEN coalesce(row[j - 1], 0) + 1 ELSE row[j] END)))))"""


def distinct_pairs(source: str) -> str:
    """The table that BLOCK_RATIOS starts from, of a source with a and b."""
    return (f"pairs AS (SELECT a, b, row_number() OVER (ORDER BY a, b) AS pair "
            f"FROM (SELECT DISTINCT a, b FROM ({source}) WHERE a IS NOT NULL AND b IS NOT NULL))")

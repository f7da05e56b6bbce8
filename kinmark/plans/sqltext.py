"""Pieces of SQL for the queries that run beside ours."""

from __future__ import annotations

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PUNCT = r"""[!"#$%&''()*+,./:;<=>?@\[\\\]^_`{|}~]"""
PUNCT_HYPHEN = r"""[!"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
PUNCT_DIGITS_NO_COMMA = r"""[!"#$%&''()*+\-./:;<=>?@\[\\\]^_`{|}~0-9]"""
CORPORATE = "['co','corp','llc','lp','llp','pllc','inc','pc','dba','gp','cic','cio','ltd','plc','eg','ag','sa','sas','ptp']"


def compress(x: str) -> str:
    """Runs of white space to one blank, none at the ends."""
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def strip(x: str) -> str:
    """No white space at the ends."""
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def name_key(x: str) -> str:
    """The normalised name."""
    return compress(f"strip_accents(regexp_replace(lower({x}), '{PUNCT}', ' ', 'g'))")


def letters_key(x: str) -> str:
    """Letters and commas only."""
    return compress(f"strip_accents(regexp_replace({strip(f'lower({x})')}, '{PUNCT_DIGITS_NO_COMMA}', ' ', 'g'))")


def collapse(x: str) -> str:
    """Words between single blanks."""
    return compress(f"strip_accents(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g'))")


def year_quality(rec: str, rec_type: str, auth: str, born: bool) -> str:
    """Compatibility of a record's date with an authority's."""
    op, kind = (">=", "Birth") if born else ("<=", "Death")
    return (
        f"CASE WHEN {rec} IS NULL OR {auth} IS NULL THEN -1 WHEN {rec_type} LIKE '%#Active' THEN CASE WHEN {rec} {op} {auth} THEN 1 ELSE 0 END "
        f"WHEN {rec_type} LIKE '%#{kind}' THEN CASE WHEN year({rec}) = year({auth}) THEN 3 WHEN abs(year({rec}) - year({auth})) < 10 THEN 2 ELSE 0 END ELSE -1 END"
    )


def authority_date(x: str, end: bool) -> str:
    """Date of yyyy, yyyy-mm or yyyy-mm-dd."""
    part = "'-12-31'" if end else "'-01-01'"
    month = f"try_cast({x} || '-1' AS DATE)"
    month = f"last_day({month})" if end else month
    return f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}$') THEN try_cast({x} || {part} AS DATE) WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{1,2}}$') THEN {month} WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN try_cast({x} AS DATE) END"

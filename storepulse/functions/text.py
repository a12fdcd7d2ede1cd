"""One tokenizer for documents and keywords, and keyword predicates built on it.

Tokens of the lower-cased text: each Han character is one token (those scripts put no
spaces between words), and so is every maximal run of other letters, marks, decimal
digits and connector punctuation. Matching a keyword term is done with a word-bounded
regular expression on the whole text, which is exactly "the term is one of the tokens"
without materialising token arrays; counting uses ``regexp_count`` the same way.
"""

from __future__ import annotations

import regex

from pyspark.sql import Column
from pyspark.sql import functions as F

_HAN = r"\p{IsHan}"
_WORD = r"[\p{L}\p{M}\p{Nd}\p{Pc}&&[^\p{IsHan}]]"
_TOKEN = f"{_HAN}|{_WORD}+"
# The same rule for keywords, which are split on the driver.
_PY_TOKEN = regex.compile(r"(?V1)\p{Han}|[[\p{L}\p{M}\p{Nd}\p{Pc}]--\p{Han}]+")
_PY_HAN = regex.compile(r"\p{Han}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Array of tokens (lower case)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(_TOKEN), F.lit(0))


def token_count(text) -> Column:
    """Number of tokens, without building the array."""
    return F.regexp_count(F.lower(_col(text)), F.lit(_TOKEN))


def keyword_terms(keyword: str | None) -> list[str]:
    """Distinct tokens of a keyword in first-seen order; empty for None/blank."""
    if not keyword:
        return []
    seen: dict[str, None] = {}
    for t in _PY_TOKEN.findall(keyword.lower()):
        seen.setdefault(t, None)
    return list(seen)


def _term_regex(term: str) -> str:
    literal = r"\Q" + term + r"\E"
    return literal if _PY_HAN.fullmatch(term) else f"(?<!{_WORD}){literal}(?!{_WORD})"


def has_term(text, term: str) -> Column:
    """True when ``term`` is one of the tokens of ``text``."""
    return F.lower(_col(text)).rlike(_term_regex(term))


def term_count(text, term: str) -> Column:
    """How many tokens of ``text`` equal ``term``."""
    return F.regexp_count(F.lower(_col(text)), F.lit(_term_regex(term)))


def match_all(text, keyword: str | None) -> Column:
    """AND-match: every keyword token occurs in ``text``; an empty keyword matches nothing."""
    terms = keyword_terms(keyword)
    if not terms:
        return F.lit(False)
    pred = None
    for t in terms:
        p = has_term(text, t)
        pred = p if pred is None else (pred & p)
    return F.coalesce(pred, F.lit(False))

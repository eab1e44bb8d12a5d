"""Names and other text as column expressions; all run in the JVM.

Absent text is '' throughout: null gives ''.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkgraph import vocab

_FROM, _TO, _MANY = vocab.folding()
#: Only these change length and may occur in names; others of that kind are rare symbols and become spaces.
_LONGER = {k: v for k, v in _MANY.items() if k in vocab.CYRILLIC or k in vocab.LATIN or "ﬀ" <= k <= "ﬆ"}
_RANKS = vocab.legal_form_ranks()
_LONGEST_FORM = max(len(k.split()) for k in _RANKS)


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, with c computed once however often f names it."""
    return F.get(F.transform(F.array(c), f), 0)


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def fold(c: Column) -> Column:
    """Lower case without accents, Cyrillic and special Latin letters romanised."""
    out = F.regexp_replace(F.lower(text_of(c)), r"\p{Mn}", "")
    out = F.translate(out, _FROM, _TO)
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), _LONGER.items(), out)


def normalize_text(c: Column) -> Column:
    """Folded; all but letters, digits and _ become spaces, and runs of spaces one."""
    return F.trim(F.regexp_replace(fold(c), r"[^\p{L}\p{N}_]+", " "))


def tokens(norm: Column) -> Column:
    """Words of normalised text; '' has none."""
    return F.filter(F.split(norm, " "), lambda t: t != "")


def sorted_tokens(norm: Column) -> Column:
    return F.array_join(F.array_sort(tokens(norm)), " ")


def legal_form(c: Column) -> Column:
    """struct(base, tag): the name without one legal form at its end or beginning, and the form's tag ('' if none).

    Of all forms that stand at either side with another word left, the one of best rank counts, at the
    end before the beginning.
    """
    return bound(tokens(normalize_text(c)), _split_form)


def _split_form(words: Column) -> Column:
    n = F.size(words)
    table = F.create_map(*[x for k, (r, t) in _RANKS.items() for x in (F.lit(k), F.struct(F.lit(r).alias("rank"), F.lit(t).alias("tag")))])
    tries = []
    for k in range(1, _LONGEST_FORM + 1):
        for side, (form, base) in enumerate([(F.slice(words, -k, k), F.slice(words, 1, n - k)), (F.slice(words, 1, k), F.slice(words, k + 1, n - k))]):
            hit = F.try_element_at(table, F.array_join(form, " "))
            tries.append(F.when((n > k) & hit.isNotNull(), F.struct(hit["rank"].alias("rank"), F.lit(side).alias("side"), F.array_join(base, " ").alias("base"), hit["tag"].alias("tag"))))
    best = F.array_min(F.array_compact(F.array(*tries)))
    return bound(best, lambda b: F.struct(F.coalesce(b["base"], F.array_join(words, " ")).alias("base"), F.coalesce(b["tag"], F.lit("")).alias("tag")))


def company_fingerprint(c: Column) -> Column:
    """Sorted words of the name without its legal form."""
    return sorted_tokens(legal_form(c)["base"])


def strip_titles(c: Column) -> Column:
    """Normalised name without leading titles and trailing suffixes or Roman numerals."""
    out = F.regexp_replace(normalize_text(c), rf"^(?:(?:{'|'.join(vocab.TITLES)})(?: |$))+", "")
    return F.trim(F.regexp_replace(out, rf"(?:(?:^| )(?:{'|'.join(vocab.SUFFIXES)}|{vocab.ROMAN}))+$", ""))


def person_parts(name: Column, forename: Column | None = None, middle: Column | None = None, surname: Column | None = None) -> Column:
    """struct(first, middle, last); a given surname decides, else the name's words do."""
    parsed = bound(
        tokens(strip_titles(name)),
        lambda w: F.struct(
            F.when(F.size(w) > 1, F.element_at(w, 1)).otherwise("").alias("first"),
            F.when(F.size(w) > 2, F.array_join(F.slice(w, 2, F.size(w) - 2), " ")).otherwise("").alias("middle"),
            F.when(F.size(w) > 0, F.element_at(w, -1)).otherwise("").alias("last"),
        ),
    )
    if surname is None:
        return parsed
    given = F.struct(*(normalize_text(x if x is not None else F.lit("")).alias(k) for x, k in ((forename, "first"), (middle, "middle"), (surname, "last"))))
    return F.when(text_of(surname) != "", given).otherwise(parsed)


def person_fingerprint(parts: Column) -> Column:
    """First and last name, sorted as whole strings."""
    return bound(parts, lambda p: F.array_join(F.array_sort(F.filter(F.array(p["first"], p["last"]), lambda x: x != "")), " "))


def phonetic_key(c: Column) -> Column:
    """Soundex of each word. Words that don't begin with an ASCII letter stay as they are."""
    return F.array_join(F.transform(tokens(normalize_text(c)), lambda t: F.soundex(t)), " ")


def initials(c: Column) -> Column:
    return F.array_join(F.transform(tokens(normalize_text(c)), lambda t: F.substring(t, 1, 1)), "")


def search_form(c: Column) -> Column:
    """What names and questions are compared by in search: lower case, ASCII letters and digits, single spaces."""
    return F.trim(F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", " "))

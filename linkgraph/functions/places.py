"""Addresses, countries and registration numbers as column expressions. Null gives ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkgraph import vocab
from linkgraph.functions.text import bound, normalize_text, text_of, tokens

# Fixed value: a UK postcode.
POSTCODE = r"^([A-Z]{1,2}[0-9][A-Z0-9]?) ([0-9][A-Z]{2})$"


def postcode(c: Column) -> Column:
    """'OUT IN' of a UK postcode, however spaced; '' if it isn't one."""
    def spaced(raw: Column) -> Column:
        n = F.length(raw)
        return F.when(n.between(5, 8), F.concat(F.substring(raw, F.lit(1), n - 3), F.lit(" "), F.substring(raw, n - 2, F.lit(3)))).otherwise("")

    return bound(bound(F.upper(F.regexp_replace(text_of(c), r"\s+", "")), spaced), lambda p: F.when(p.rlike(POSTCODE), p).otherwise(""))


def postcode_district(c: Column) -> Column:
    return F.split_part(postcode(c), F.lit(" "), F.lit(1))


def postcode_area(c: Column) -> Column:
    return F.regexp_extract(postcode(c), "^[A-Z]{1,2}", 0)


def join_address(*parts: Column) -> Column:
    """Parts that aren't empty, normalised as one text."""
    return normalize_text(F.concat_ws(" ", *(F.nullif(text_of(p), F.lit("")) for p in parts)))


def address_key(*parts: Column) -> Column:
    """'number|POSTCODE' where a word, or else the last two, are a postcode ('|POSTCODE' without number); else the first four words that tell something.

    A stated country behind the postcode hides an address's spaced postcode, as in the registers.
    """
    return bound(tokens(join_address(*parts)), _key_of_words)


def _key_of_words(words: Column) -> Column:
    single = F.filter(F.transform(F.reverse(words), postcode), lambda p: p != "")
    pair = postcode(F.when(F.size(words) > 1, F.array_join(F.slice(words, -2, 2), "")).otherwise(""))
    pc = F.when(F.size(single) > 0, F.get(single, 0)).otherwise(pair)
    number = F.coalesce(F.get(F.filter(words, lambda t: t.rlike("^[0-9]+$")), 0), F.lit(""))
    loose = F.array_join(F.slice(F.filter(words, lambda t: ~t.isin(vocab.ADDRESS_STOPWORDS)), 1, 4), " ")
    return bound(pc, lambda p: F.when(p != "", F.concat(number, F.lit("|"), p)).otherwise(loose))


def country_code(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """ISO code of a country's name, demonym or code; of several, the first. '' if unknown.

    aliases (normalised name to code) adds to the table and overrides it.
    """
    table = vocab.country_aliases(aliases)
    names = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    raw = F.trim(text_of(c))
    known = F.when((F.length(raw) == 2) & F.upper(raw).isin(sorted({*table.values()})), F.upper(raw))
    out = F.coalesce(known, F.try_element_at(names, normalize_text(raw)))
    lowered = F.lower(raw)
    head = F.lit(None).cast("string")
    for sep in reversed([",", "/", ";", "&", " and "]):
        part = F.try_element_at(names, normalize_text(F.substring_index(lowered, sep, 1)))
        head = F.when(F.contains(lowered, F.lit(sep)), F.coalesce(part, head)).otherwise(head)
    return F.coalesce(out, head, F.lit(""))


def is_secrecy(iso: Column) -> Column:
    return F.upper(iso).isin(vocab.SECRECY)


def company_number(c: Column) -> Column:
    """Letters and digits in upper case; digits alone, or behind letters, padded to eight characters in all."""

    def padded(raw: Column) -> Column:
        letters, digits = F.regexp_replace(raw, r"[^\p{L}]", ""), F.regexp_replace(raw, "[^0-9]", "")
        return F.when(digits != "", F.concat(letters, F.lpad(digits, F.greatest(F.length(digits), F.lit(8) - F.length(letters)), "0"))).otherwise(raw)

    return bound(F.regexp_replace(F.upper(text_of(c)), r"[^\p{L}\p{N}]", ""), padded)

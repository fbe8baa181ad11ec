"""Text functions as column expressions: all run in the JVM, inside code generation where Spark has it."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

STOP_WORDS = tuple("a an and are as at be by for from in into is of on or that the their this to using via with".split())


def _folding() -> tuple[str, str, dict[str, str]]:
    """Of all of Unicode the characters that decompose to one ASCII character, what each becomes, and those that become several."""
    one, to, more = [], [], {}
    for c in range(0x80, 0x110000):
        if 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xF900 or 0x20000 <= c < 0xE0000:
            continue  # ideographs, syllables, surrogates and private ones, none of which holds an ASCII character
        plain = unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one.append(chr(c))
            to.append(plain)
        elif plain:
            more[chr(c)] = plain
    return "".join(one), "".join(to), more


_ONE, _TO, _MORE = _folding()


def _ranges(chars: list[int], gap: int = 16) -> str:
    """A short character class that has at least ``chars``: a class of hundreds of single ones is tried one by one for each character of a text."""
    out, low, high = [], chars[0], chars[0]
    for c in [*chars[1:], 0x110000]:
        if c > high + gap:
            out.append(f"{chr(low)}-{chr(high)}")
            low = c
        high = c
    return "[" + "".join(out) + "]"


_MAYBE = _ranges(sorted(map(ord, _MORE)))


def fold(x: Column) -> Column:
    """Compatibility decomposition with all but ASCII dropped: ``é`` gives ``e``, ``ﬁ`` gives ``fi``, ``ß`` gives nothing."""
    rest = F.regexp_replace(x, "[\\x00-\\x7F]+", "")
    # read from one literal, which the optimizer folds: a map of some 900 literals is slow to plan wherever this expression is repeated
    to = F.str_to_map(F.lit("\x02".join(f"{c}\x01{plain}" for c, plain in _MORE.items())), F.lit("\x02"), F.lit("\x01"))
    # the few characters that a text has of those that become several are replaced one after the other
    own = F.array_distinct(F.regexp_extract_all(rest, F.lit(f"({_MAYBE})"), F.lit(1)))
    many = F.aggregate(own, x, lambda s, c: F.replace(s, c, F.coalesce(F.element_at(to, c), c)))
    plain = F.translate(F.when(rest.rlike(_MAYBE), many).otherwise(x), _ONE, _TO)
    return F.when(rest != "", F.regexp_replace(plain, "[^\\x00-\\x7F]+", "")).otherwise(x)


def words_of(x: Column) -> Column:
    """Runs of letters and digits of the folded, then lowered text."""
    return F.regexp_extract_all(F.lower(fold(x)), F.lit("([a-z0-9]+)"), F.lit(1))


def normalized(x: Column) -> Column:
    return F.array_join(words_of(x), " ")


def title_tokens(x: Column) -> Column:
    """The words that aren't stop words, repeats and order kept."""
    return F.filter(words_of(x), lambda t: ~t.isin(*STOP_WORDS))


def ngrams(tokens: Column, low: int = 1, high: int = 3) -> Column:
    """All runs of ``low`` to ``high`` tokens, joined by spaces, by length and then place."""
    run, out = tokens, tokens if low <= 1 <= high else F.array().cast("array<string>")
    for n in range(2, high + 1):
        # runs of n are runs of n - 1 side by side with the tokens n - 1 on; a list that is too short gives none
        length = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        run = F.zip_with(F.slice(run, F.lit(1), length), F.slice(tokens, F.lit(n), length), lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, run) if n >= low else out
    return out


def match_key(x: Column) -> Column:
    """Lowered, folded, and only letters and digits."""
    return F.regexp_replace(fold(F.lower(x)), "[^a-z0-9]+", "")


def title_hint(x: Column) -> Column:
    """The part of a file name behind `` - YEAR - ``, a note of its origin dropped; the whole where there is no year."""
    bare = F.regexp_replace(x, r"__from-raw-pdf-\d{4}-\d{2}-\d{2}$", "")
    hint = F.trim(F.regexp_extract(bare, r"\s-\s\d{4}\s-\s(.+)$", 1))
    return F.when(hint != "", hint).otherwise(F.trim(bare))


def doi(x: Column) -> Column:
    bare = F.regexp_replace(F.trim(x), r"(?i)^https?://(dx\.)?doi\.org/", "")
    return F.lower(F.trim(F.regexp_replace(bare, r"(?i)^doi:\s*", "")))


def doi_slug(x: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(doi(x), "[^a-z0-9._-]+", "-"), "-+", "-")
    slug = F.regexp_replace(slug, "^-+|-+$", "")
    return F.when(slug == "", "unknown-doi").otherwise(slug)


def base_name(x: Column) -> Column:
    return F.concat(F.lit("doi-"), doi_slug(x))


def legacy_base_name(document_id: Column, x: Column) -> Column:
    return F.concat(document_id, F.lit("__doi-"), doi_slug(x))


def parsed_base_name(x: Column) -> Column:
    """STRUCT(format, doi_slug, document_id) of ``doi-SLUG`` or ``ID__doi-SLUG``; null for anything else."""
    new, old = F.regexp_extract(x, "^doi-(.+)$", 1), r"^([^_]+)__doi-(.+)$"
    return F.when(new != "", F.struct(F.lit("doi").alias("format"), new.alias("doi_slug"), F.lit(None).cast("string").alias("document_id"))).when(
        F.regexp_extract(x, old, 2) != "", F.struct(F.lit("legacy").alias("format"), F.regexp_extract(x, old, 2).alias("doi_slug"), F.regexp_extract(x, old, 1).alias("document_id"))
    )


def doi_within(x: Column) -> Column:
    """The first DOI that a text holds, its closing punctuation dropped; null without one."""
    found = F.regexp_replace(F.regexp_extract(x, r"(?i)(10\.\d{4,9}/[-._;()/:a-z0-9]+)", 1), r"[.,;:_-]+$", "")
    return F.when(found != "", doi(found))


def optional(x: Column) -> Column:
    """Trimmed; null for an empty text, ``none``, ``null`` and ``nan``."""
    t = F.trim(x)
    return F.when(~F.lower(t).isin("", "none", "null", "nan"), t)


def split_words(x: Column) -> Column:
    """Words between white space of any script, never an empty one."""
    return F.filter(F.split(x, r"(?U)\s+"), lambda t: t != "")


def word_count(x: Column) -> Column:
    return F.size(split_words(x))


def preview(x: Column, most: int) -> Column:
    """The first ``most`` words, with ``...`` if there are more; an empty text for null."""
    w = split_words(F.coalesce(x, F.lit("")))
    return F.concat(F.array_join(F.slice(w, 1, most), " "), F.when(F.size(w) > most, "...").otherwise(""))


def cut_abstract(x: Column, most: int) -> Column:
    """As ``preview`` where the text is longer, else as it is."""
    return F.when(word_count(x) > most, preview(x, most)).otherwise(x)


def section_title(x: Column) -> Column:
    """Lowered, with ``:;,.!?()[]{}`` as spaces, and spaces collapsed."""
    return F.array_join(split_words(F.translate(F.lower(x), ":;,.!?()[]{}", " " * 12)), " ")


def latex(x: Column) -> Column:
    """Curly quotes made straight and ``& % $ # _`` escaped."""
    return F.regexp_replace(F.translate(F.coalesce(x, F.lit("")), "’‘“”", "''\"\""), r"([&%$#_])", r"\\$1")


def year_within(x: Column) -> Column:
    return F.regexp_extract(x.cast("string"), r"\b((?:19|20)\d{2})\b", 1)


def estimated_tokens(x: Column) -> Column:
    """A quarter of the trimmed length, to the even number on a tie, at least 1; 0 for a blank text."""
    n = F.length(F.regexp_replace(x, r"^(?U)\s+|(?U)\s+$", ""))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.bround(n / 4, 0).cast("int")))


def is_definition(block: Column) -> Column:
    """Whether a block only explains abbreviations or grading terms."""
    t = F.regexp_replace(F.array_join(split_words(block), " "), "^(?:[-*•†‡]+\\s*)+", "")
    equals, colons = F.length(t) - F.length(F.replace(t, F.lit("="), F.lit(""))), F.length(t) - F.length(F.replace(t, F.lit(":"), F.lit("")))
    graded = r"(?i)^(patient or population|setting|intervention|comparison|risk of bias|publication bias|imprecision|indirectness|inconsistency)\s*:"
    # two abbreviations explained have two equals signs, so that pattern needs no test of its own
    return (t != "") & (t.rlike(graded) | (equals >= 2) | ((colons >= 2) & (word_count(t) <= 45)))


def without_definitions(x: Column) -> Column:
    kept = F.filter(F.split(x, "\n\n"), lambda b: ~is_definition(b) & (F.trim(b) != ""))
    return F.trim(F.array_join(F.transform(kept, lambda b: F.trim(b)), "\n\n"))


def short_upper(x: Column) -> Column:
    """At most 80 characters and 8 words, no closing ``.,;``, at least one letter and none in lower case."""
    t = F.array_join(split_words(x), " ")
    return (t != "") & (F.length(t) <= 80) & ~t.rlike("[.,;]$") & (word_count(F.replace(t, F.lit(":"), F.lit(""))) <= 8) & t.rlike(r"\p{L}") & ~t.rlike(r"\p{Ll}")


def title_case(x: Column) -> Column:
    """1 to 8 words without closing punctuation, all but one of which, connecting words aside, begin with a capital."""
    t = F.array_join(split_words(x), " ")
    w = split_words(F.replace(t, F.lit(":"), F.lit("")))
    own = F.filter(w, lambda v: ~F.lower(v).isin("and", "or", "of", "the", "in", "on", "for", "to", "with", "by"))
    capital = F.size(F.filter(own, lambda v: v.rlike(r"^\p{Lu}")))
    return (t != "") & (F.length(t) <= 80) & ~t.rlike("[.,;?!]$") & (F.size(w) >= 1) & (F.size(w) <= 8) & (capital >= F.greatest(F.lit(1), F.size(own) - 1))


def heading_signal(x: Column) -> Column:
    return F.when(short_upper(x), "uppercase").when(title_case(x), "titlecase")


def is_abstract(x: Column) -> Column:
    return F.upper(F.array_join(split_words(x), " ")).isin("ABSTRACT", "SUMMARY", "EXECUTIVE SUMMARY")

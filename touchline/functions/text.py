"""Text normalisers as native column expressions (no Python UDF).

Spark's regexes are Java's: case folding beyond ASCII needs ``(?iu)`` and Unicode white space ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: letters and their replacements, in the order they are applied.

CYRILLIC_SINGLE = ("абвгдежзијклмнопрстуфхцчш", "abvgdežzijklmnoprstufhcčš")
CYRILLIC_PLAIN = ("абвгдежзијклмнопрстуфхцчш", "abvgdezzijklmnoprstufhccs")
CYRILLIC_DOUBLE = {"ѓ": "gj", "ѕ": "dz", "љ": "lj", "њ": "nj", "ќ": "kj", "џ": "dž"}
CYRILLIC_DOUBLE_PLAIN = CYRILLIC_DOUBLE | {"џ": "dz"}
LATIN_PAIRS = {"zh": "ж", "sh": "ш", "ch": "ч", "nj": "њ", "lj": "љ", "kj": "ќ", "gj": "ѓ", "dz": "ѕ", "dj": "џ"}
LATIN_SINGLE = ("abcdefghijklmnopqrstuvwyzčšžđćç", "абцдефгхијклмнопкрстуввјзчшжѓќч")
ACCENTED = ("čšžđćǵḱńĺñëçßüöäáéíóúàèìòùâêîôû", "cszdcgknlnecsuoaaeiouaeiouaeiou")
ACCENTED_SLUG = (
    "àáâãäåāăąçćčďđèéêëēėęģğǵħìíîïīįķĺļľłñńňņòóôõöøōőŕřśšşșťţțùúûüūůűŷýÿžźż",
    "aaaaaaaaacccddeeeeeeeggghiiiiiikllllnnnnoooooooorrsssstttuuuuuuuwyyzzz",
)
TRIGRAPHS = {"dzh": "z", "sch": "s", "tch": "c", "dgh": "g"}
DIGRAPHS = {
    "xh": "z", "sh": "s", "ch": "c", "zh": "z", "gj": "g", "kj": "k", "nj": "n", "lj": "l", "dj": "d", "dz": "z", "dh": "d", "th": "t", "ah": "a", "ph": "f",
}
DOUBLES = tuple("lsrtfnmpbdgcz")
ACRONYMS = ("ОФЛ", "ФФМ", "МФЛ", "КУП", "РМ", "ОФС")
LOWER_WORDS = ("запад", "југ", "север", "исток", "југозапад", "југоисток", "за", "на", "и")
CLUB_PREFIX = r"(?iu)^\s*(жфк|шфк|фк|zfk|shfk|fk)\s+"


def replaced(c: Column, pairs: dict[str, str]) -> Column:
    """Literal replacements one after another, in the order given."""
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def squish(c: Column) -> Column:
    """Unicode white space (no-break space included) to single spaces, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def join_key(c: Column) -> Column:
    """Key for matching names: squished and lower-cased."""
    return F.lower(squish(c))


def team_key(c: Column) -> Column:
    """``join_key``, empty becoming null."""
    return F.nullif(join_key(c), F.lit(""))


def club_key(c: Column) -> Column:
    """Club name without a leading club-type abbreviation, as a join key."""
    return F.regexp_replace(join_key(c), CLUB_PREFIX, "")


def non_empty(c: Column) -> Column:
    """Null for empty text and for a written-out 'na'."""
    s = squish(c)
    return F.when(F.lower(s).isin("", "na"), None).otherwise(s)


def is_latin(c: Column) -> Column:
    return F.coalesce(c.rlike("[A-Za-zÀ-ſ]"), F.lit(False))


def capitalise_words(c: Column, keep_empty: bool = True) -> Column:
    """First letter of every space-separated word in upper case, the rest untouched."""
    words = F.split(c, " ", -1)
    if not keep_empty:
        words = F.filter(words, lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def title_case(c: Column) -> Column:
    """Every run of letters begins with a capital, hyphenated parts included (``initcap`` splits on spaces only)."""
    marked = F.regexp_replace(F.lower(c), r"(?U)(?<![\p{L}\p{M}'’])(\p{L})", "\u0001$1")
    parts = F.split(marked, "\u0001", -1)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))), "")


def latin_to_cyrillic(c: Column, keep_empty: bool = True) -> Column:
    """Pairs of letters first, then ``x``, then single letters; words capitalised."""
    text = replaced(F.lower(c), LATIN_PAIRS | {"x": "кс"})
    return F.when(c == "", c).otherwise(capitalise_words(F.translate(text, *LATIN_SINGLE), keep_empty))


def cyrillic_to_latin(c: Column) -> Column:
    """Lower-case transliteration with diacritics, then title case."""
    return title_case(replaced(F.translate(F.lower(c), *CYRILLIC_SINGLE), CYRILLIC_DOUBLE))


def standard_name(c: Column) -> Column:
    """Names in Latin letters go to Cyrillic; others stay."""
    return F.when(is_latin(c), latin_to_cyrillic(c)).otherwise(c)


def slug(c: Column, override: Column | None = None) -> Column:
    """Identifier for file names and urls: plain Latin, ``a-z0-9_-`` only; ``override`` replaces the name if not blank."""
    text = replaced(F.translate(F.lower(c), *CYRILLIC_PLAIN), CYRILLIC_DOUBLE_PLAIN)
    if override is not None:
        text = F.when(F.trim(override) != "", F.lower(override)).otherwise(text)
    text = F.translate(F.replace(text, F.lit("œ"), F.lit("oe")), *ACCENTED_SLUG)
    text = F.regexp_replace(text, r"[\s/]+", "_")
    text = F.regexp_replace(text, r"[^a-z0-9_\-]+", "")
    return F.regexp_replace(F.regexp_replace(text, "_{2,}", "_"), "^_+|_+$", "")


def search_terms(c: Column) -> Column:
    """One plain lower-case spelling for all scripts and spellings of a name; blank and null give ''."""
    text = replaced(F.translate(F.lower(c), *CYRILLIC_PLAIN), CYRILLIC_DOUBLE_PLAIN)
    text = F.translate(text, *ACCENTED)
    text = replaced(text, TRIGRAPHS)
    text = replaced(text, DIGRAPHS)
    text = replaced(text, {d + d: d for d in DOUBLES})
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", "").otherwise(text)


def search_matches(terms: Column, query: str) -> Column:
    """Whether normalised terms hold the normalised query (two characters at least)."""
    return F.when(F.length(F.trim(F.lit(query))) < 2, False).otherwise(terms.contains(search_terms(F.lit(query))))


def last_word(c: Column) -> Column:
    return F.element_at(F.split(squish(c), " "), -1)


def last_word_first(c: Column) -> Column:
    """'Surname ... First' to 'First Surname ...'; single words stay."""
    words = F.split(c, r"\s+", -1)
    return F.when(F.size(words) < 2, c).otherwise(F.concat_ws(" ", F.element_at(words, -1), F.array_join(F.slice(words, 1, F.size(words) - 1), " ")))


def reversed_words(c: Column) -> Column:
    return F.array_join(F.reverse(F.split(c, " ")), " ")


def mapped_list(c: Column, mapping: dict[str, str] | None = None, joiner: str = " / ") -> Column:
    """'A / B; A' to distinct parts in first-seen order, each mapped where known."""
    parts = F.filter(F.transform(F.split(c, r"\s*[/;]\s*"), lambda p: F.trim(p)), lambda p: p != "")
    if mapping:
        known = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        parts = F.transform(parts, lambda p: F.coalesce(F.try_element_at(known, p), p))
    return F.array_join(F.array_distinct(parts), joiner)


def distinct_words(c: Column) -> Column:
    return F.array_join(F.array_distinct(F.split(c, " ")), " ")


def strip_parenthesis(c: Column) -> Column:
    """Without a trailing '(...)'."""
    return F.trim(F.regexp_replace(c, r"\s*\([^)]*\)\s*$", ""))


def group_label(c: Column) -> Column:
    """Text of a trailing parenthesis, else null."""
    return F.nullif(F.regexp_extract(c, r"\(([^)]*)\)\s*$", 1), F.lit(""))


def quiet_capitals(c: Column, acronyms: tuple[str, ...] = ACRONYMS, lower_words: tuple[str, ...] = LOWER_WORDS) -> Column:
    """If a text has three Cyrillic capitals or more in a row, its words get title case, acronyms and small words kept.

    Words are compared without punctuation and without regard to case.
    """
    shout = c.rlike("[А-Я]{3,}")

    def word(w: Column) -> Column:
        bare = F.lower(F.regexp_replace(w, "[^А-Яа-яA-Za-z0-9]", ""))
        return F.when(F.upper(bare).isin(*acronyms), F.upper(w)).when(bare.isin(*lower_words), F.lower(w)).otherwise(title_case(w))

    return F.when(shout, F.array_join(F.transform(F.split(c, r"\s+"), word), " ")).otherwise(c)


def note_lines(c: Column) -> Column:
    """Written-out and Windows line ends to '\\n', runs of them to one."""
    text = F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\r"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(text, r"\n{2,}", "\n"), r"^\s+|\s+$", "")


def sql_paste(*cols: Column, sep: str = " ") -> Column:
    """Concatenation in which a null reads 'NA' (keys built that way must match)."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])

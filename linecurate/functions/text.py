"""Text and number columns, all JVM-side expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"


def _plain_forms() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition without combining marks is another character, those
    characters (one fewer for each that is nothing but a mark), and what decomposes into several."""
    one, marks, several = [], [], {}
    for c in map(chr, (*range(0x80, 0xAC00), *range(0xF900, 0x10000))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain == c:
            continue
        if not plain:
            marks.append(c)
        elif len(plain) == 1:
            one.append((c, plain))
        elif any(x.isascii() and x.isalnum() for x in plain):
            several[c] = plain
    return "".join([a for a, _ in one] + marks), "".join(b for _, b in one), several


ACCENTED, PLAIN, SEVERAL = _plain_forms()


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- identifiers


def hex_id(ident: Column | str) -> Column:
    """0x%08x of an unsigned number."""
    return F.format_string("0x%08x", col(ident).cast("long"))


def normalize_id(text: Column | str) -> Column:
    """Canonical 0x id of a trimmed, lower-cased text; null if it isn't one."""
    t = F.lower(F.trim(col(text)))
    return F.when(t.rlike("^0x[0-9a-f]{8}$"), t)


def parse_ident(text: Column | str) -> Column:
    """Number of a decimal or 0x literal from 0 to 2**32 - 1; null otherwise."""
    t = F.lower(F.trim(col(text)))
    n = F.when(t.rlike("^0x[0-9a-f]{1,16}$"), F.conv(F.substr(t, F.lit(3)), 16, 10)).when(t.rlike("^[0-9]{1,18}$"), t).cast("decimal(20,0)")
    return F.when((n >= 0) & (n < 2**32), n.cast("long"))


# --- folding and spacing


def plain(text: Column | str) -> Column:
    """Letters without their accents, precomposed or not, and compatibility forms as plain ones."""
    several = F.str_to_map(F.lit("\u0002".join(f"{a}\u0003{b}" for a, b in SEVERAL.items())), F.lit("\u0002"), F.lit("\u0003"))
    letters, t = "".join(SEVERAL), col(text)
    # dropping characters is much faster than looking for so many by a pattern
    t = F.when(F.translate(t, letters, "") != t, replace_each(t, f"[{letters}]", lambda m: F.element_at(several, m))).otherwise(t)
    return F.translate(t, ACCENTED, PLAIN)


def replace_each(text: Column, pattern: Column | str, new: Callable[[Column], Column], *groups: int) -> Column:
    """text with each match of pattern replaced by new(match), or new(struct of the match, g1, g2 ...) if groups are asked for."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, regex, F.lit(0))
    if groups:
        found = F.arrays_zip(found.alias("g0"), *[F.regexp_extract_all(text, regex, F.lit(g)).alias(f"g{g}") for g in groups])
    between = F.split(text, regex, -1)
    after = F.zip_with(found, F.slice(between, F.lit(2), F.size(between)), lambda m, rest: F.concat(new(m), rest))
    return F.concat(F.get(between, F.lit(0)), F.array_join(after, ""))


def given(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space at the ends, line feeds included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def fold(text: Column | str) -> Column:
    """Accents dropped, lower case, runs of anything but a-z and 0-9 as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(plain(text)), "[^a-z0-9]+", " "))


def fold_spacing(text: Column | str) -> Column:
    """Accents dropped, lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(plain(text)), r"\s+", " "))


def normalize_term(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.replace(col(text), F.lit("’"), F.lit("'")), r"\s+", " "))


def safe_name(text: Column | str, default: str = "termo") -> Column:
    """File-name form: ASCII, other characters than A-Za-z0-9._'- as _, at most 70 characters."""
    ascii_ = F.regexp_replace(plain(text), r"[^\x00-\x7F]", "")
    name = F.left(F.regexp_replace(F.regexp_replace(ascii_, r"[^\w.'-]+", "_"), "^[_.]+|[_.]+$", ""), F.lit(70))
    return given(name, lambda n: F.when(F.coalesce(n, F.lit("")) == "", default).otherwise(n))


def clean_spacing(text: Column | str) -> Column:
    """No blank before marks, one after a sentence mark, single blanks, no leading , ; or :."""
    t = F.regexp_replace(col(text), r"\s+([,.;:!?…])", "$1")
    t = F.regexp_replace(t, f"([.!?…])(?={LETTER})", "$1 ")
    t = F.trim(F.regexp_replace(t, r"\s{2,}", " "))
    return F.regexp_replace(t, r"^[,;:]\s*", "")


# Marked words that stand for sounds.
NONVERBAL = ("assobia", "assobio", "cheira", "cheirando", "cof", "cof cof", "cof, cof", "hrrm", "risos", "snif", "sniff", "suspira", "suspiro", "tsc", "zomba")


def clean_markup(text: Column | str, sounds: Sequence[str] = NONVERBAL) -> Column:
    """Starred sounds go, other starred words lose their stars; blanks and one leading mark are tidied."""
    names = "|".join(s.replace(" ", r"\s+") for s in sorted(sounds, key=len, reverse=True))
    t = F.regexp_replace(col(text), rf"(?iu)\*+\s*(?:{names})\s*\*+", "")
    t = F.regexp_replace(t, r"\*+([^*]+?)\*+", "$1")
    t = F.trim(F.regexp_replace(t, r"[ \t]{2,}", " "))
    return F.regexp_replace(t, r"^\s*[,;:]\s*", "")


def markup_tokens(text: Column | str, known: bool, sounds: Sequence[str] = NONVERBAL) -> Column:
    """Starred tokens that are (known) or aren't (not known) sounds, in order."""
    tokens = F.transform(F.regexp_extract_all(col(text), F.lit(r"\*+([^*]+?)\*+"), 1), lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")))
    return F.filter(tokens, lambda t: F.lower(t).isin(*sounds) if known else ~F.lower(t).isin(*sounds))


def preserve_case(old: Column, new: Column) -> Column:
    """new in the case of old: all upper, capitalised, or as it is."""
    upper = (F.upper(old) == old) & (F.lower(old) != old)
    capital = F.upper(F.left(old, F.lit(1))) == F.left(old, F.lit(1))
    return F.when(upper, F.upper(new)).when(capital & (F.lower(F.left(old, F.lit(1))) != F.left(old, F.lit(1))), F.concat(F.upper(F.left(new, F.lit(1))), F.substr(new, F.lit(2)))).otherwise(new)


def replace_word(text: Column | str, old: Column | str, new: Column | str) -> Column:
    """Each whole word old, whatever its case, as new in the case of what it replaces; old and new are strings or columns."""
    of = lambda x: F.lit(x) if isinstance(x, str) else x
    return replace_each(col(text), F.concat(F.lit(r"(?iuU)\b\Q"), of(old), F.lit(r"\E\b")), lambda m: preserve_case(m, of(new)))


def word_pattern(term: Column | str) -> Column:
    """Regular expression of a literal term that no letter or digit touches, whatever its case."""
    return F.concat(F.lit(r"(?iuU)(?<!\w)\Q"), col(term), F.lit(r"\E(?!\w)"))


# --- measures of a text


def words(text: Column | str) -> Column:
    return F.regexp_count(col(text), F.lit(f"{LETTER}+(?:['’-]{LETTER}+)?")).cast("long")


def alnum_words(text: Column | str) -> Column:
    return F.regexp_count(col(text), F.lit("[A-Za-zÀ-ÖØ-öø-ÿ0-9]+")).cast("long")


def letters(text: Column | str) -> Column:
    return F.regexp_count(col(text), F.lit(LETTER)).cast("long")


def syllables(text: Column | str) -> Column:
    """Vowel groups, but no fewer than words."""
    return F.greatest(words(text), F.regexp_count(F.lower(col(text)), F.lit("[aeiouáàâãéêíóôõúü]+")).cast("long"))


def inner_punctuation(text: Column | str) -> Column:
    """Pauses written inside a text, its closing marks left out."""
    return F.regexp_count(F.regexp_replace(col(text), r"[.!?…\s]+$", ""), F.lit(r"\.\.\.|[,;:—–-]")).cast("long")


def text_markers(text: Column | str) -> Column:
    """pergunta, exclamacao, reticencias joined by |, or declarativa."""
    t = col(text)
    marks = F.concat_ws("|", F.when(t.contains("?"), "pergunta"), F.when(t.contains("!"), "exclamacao"), F.when(t.rlike(r"\.\.\.|…"), "reticencias"))
    return F.coalesce(F.nullif(marks, F.lit("")), F.lit("declarativa"))


def occurrences(text: Column | str, literal: str) -> Column:
    t = col(text)
    return ((F.length(t) - F.length(F.replace(t, F.lit(literal), F.lit("")))) / len(literal)).cast("long")


def preselection_score(text: Column | str, duration: Column) -> Column:
    """Cheap score of how much a line lends itself as an expressive sample."""
    n = lambda m: occurrences(text, m)
    return (
        F.least(words(text), F.lit(35)) / 10.0 + 1.5 * (n("?") + n("!")) + 0.7 * (n("...") + n("…"))
        + 0.25 * (n(",") + n(";") + n(":")) + 0.2 * F.least(n("."), F.lit(4)) - 0.08 * F.abs(duration - 6.5)
    )


def duration_band(seconds: Column) -> Column:
    return F.when(seconds < 1.2, "curta").when(seconds < 4, "media").otherwise("longa")


def pace_band(words_per_second: Column) -> Column:
    return F.when(words_per_second < 4.5, "lento").when(words_per_second <= 7, "normal").otherwise("rapido")


def pause_band(count: Column, longest_ms: Column) -> Column:
    return F.when(count == 0, "sem_pausa").when((count <= 2) & (longest_ms <= 500), "pausa_leve").otherwise("pausa_frequente")


def profile_key(duration: Column, pace: Column, intensity: Column, pause: Column) -> Column:
    return F.concat(duration, F.lit("__ritmo_"), pace, F.lit("__int_"), intensity, F.lit("__"), pause)


# --- numbers


def as_number(text: Column | str) -> Column:
    """Double of a text with a point or comma; null if there is none or it isn't finite."""
    x = F.replace(F.trim(col(text).cast("string")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def dbfs(x: Column) -> Column:
    return 20 * F.log10(F.greatest(x, F.lit(1e-12)))


def semitones(f: Column, reference: Column) -> Column:
    return 12 * F.log2(f / reference)


def cents_apart(a: Column, b: Column) -> Column:
    return F.abs(1200 * F.log2(a / b))


def human_size(n: Column) -> Column:
    out = None
    for unit, size in (("GiB", 2**30), ("MiB", 2**20), ("KiB", 2**10)):
        text = F.format_string(f"%.2f {unit}", n / float(size))
        out = F.when(n >= size, text) if out is None else out.when(n >= size, text)
    return out.otherwise(F.format_string("%d B", n.cast("long")))


# --- lists and vectors in a cell


def first_text(*options: Column | str) -> Column:
    """The first text that is neither null nor empty, or the empty one."""
    return F.coalesce(*[F.nullif(col(o), F.lit("")) for o in options], F.lit(""))


def reasons(pairs: Iterable[tuple[Column, Column | str]], separator: str = " | ") -> Column:
    """Texts whose condition holds, in order, each once, joined."""
    texts = F.array(*[F.when(c, F.lit(t) if isinstance(t, str) else t) for c, t in pairs])
    return F.array_join(F.array_distinct(F.filter(texts, lambda t: t.isNotNull())), separator)


def vector_text(scores: Column) -> Column:
    """name:0.00|name:0.00 of an array of (name, score) structs."""
    return F.array_join(F.transform(scores, lambda s: F.concat(s["name"], F.lit(":"), F.format_string("%.2f", s["score"]))), "|")


def vector_map(text: Column | str) -> Column:
    """Map of a vector's text; null if a part has no colon or no number."""
    t = col(text)
    parts = F.transform_values(F.str_to_map(t, F.lit("[|]"), F.lit(":")), lambda _, v: v.try_cast("double"))
    return F.when(F.forall(F.map_values(parts), lambda v: v.isNotNull()), parts)

"""Tokenising expressions. Everything here stays on the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.params import Encoding

# One set of characters for "word" and "space" that Java and RE2 read alike; the short
# classes of the two differ from each other and from the meaning wanted here.
WORD = r"\p{L}\p{N}_"
SPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def portable(pattern: str) -> str:
    """Spell the short classes of a stored pattern out for the JVM regex engine."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        c, two = pattern[i], pattern[i : i + 2]
        if two in (r"\w", r"\s"):
            body = WORD if two == r"\w" else SPACE
            out.append(body if inside else f"[{body}]")
            i += 2
            continue
        if two in (r"\W", r"\S") and not inside:
            out.append(f"[^{WORD if two == chr(92) + 'W' else SPACE}]")
            i += 2
            continue
        if c == "\\":
            out.append(two)
            i += 2
            continue
        if c == "[" and not inside:
            inside = True
        elif c == "]" and inside:
            inside = False
        out.append(c)
        i += 1
    return "".join(out)


@lru_cache(maxsize=1)
def accent_tables() -> tuple[str, str]:
    """Letters whose decomposition is one base letter plus marks, and those bases."""
    source, target = [], []
    for code in range(0x80, 0x30000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = [c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0] != ch:
            source.append(ch)
            target.append(base[0])
    return "".join(source), "".join(target)


# Hangul syllables are computed from their three parts.
_HANGUL = ("\uac00", "\ud7a3")
_LEAD = "".join(map(chr, range(0x1100, 0x1113)))
_VOWEL = "".join(map(chr, range(0x1161, 0x1176)))
_TAIL = "".join(map(chr, range(0x11A8, 0x11C3)))


@lru_cache(maxsize=1)
def expanding_letters() -> dict[str, str]:
    """Letters other than Hangul whose decomposition has several base letters."""
    made = {}
    for code in range(0x80, 0x30000):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF or _HANGUL[0] <= ch <= _HANGUL[1]:
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if len(base) > 1:
            made[ch] = base
    return made


def _expanded(text: Column) -> Column:
    """Letters that decompose into several, written out; the others as they are."""
    table = F.create_map(*[F.lit(x) for pair in expanding_letters().items() for x in pair])

    def letter(c: Column) -> Column:
        at = F.ascii(c) - ord(_HANGUL[0])
        part = lambda letters, i: F.substring(F.lit(letters), i.cast("int"), F.lit(1))
        tail = at % 28
        syllable = F.concat(
            part(_LEAD, F.floor(at / 588) + 1),
            part(_VOWEL, F.floor((at % 588) / 28) + 1),
            F.when(tail > 0, part(_TAIL, tail)).otherwise(""),
        )
        return F.when(c.between(*_HANGUL), syllable).otherwise(F.coalesce(F.try_element_at(table, c), c))

    return F.array_join(F.transform(F.split(text, ""), letter), "")


def strip_accents(text: Column) -> Column:
    """Base letters only, as canonical decomposition without its marks leaves them.

    Composed letters are translated; the rare texts with letters that expand to several, such as
    Hangul, are written out letter by letter first; loose marks go.
    """
    source, target = accent_tables()
    rare = "[" + "-".join(_HANGUL) + "".join(expanding_letters()) + "]"
    whole = F.when(text.rlike(rare), _expanded(text)).otherwise(text)
    return F.regexp_replace(F.translate(whole, source, target), r"\p{Mn}", "")


def trimmed(text: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def _is_simple(enc: Encoding) -> bool:
    """True if isolating punctuation, splitting and filtering equals one extraction."""
    return enc.token_pattern == r"([^\w\s\-])" and all(
        len(p) == 1 and not (p.isalnum() or p.isspace() or p in "_-") for p in enc.keep_punctuation
    )


def _escape(chars) -> str:
    return "".join("\\" + c for c in chars)


def tokens(text: Column, enc: Encoding) -> Column:
    """The tokens of a text as ARRAY<STRING>.

    The encoding is always passed explicitly: training and annotation jobs that want the
    default preset say so.
    """
    t = text
    if enc.strip_accents:
        t = strip_accents(t)
    if enc.lowercase:
        t = F.lower(t)
    if _is_simple(enc):
        kept = f"|[{_escape(enc.keep_punctuation)}]" if enc.keep_punctuation else ""
        return F.regexp_extract_all(t, F.lit(rf"[{WORD}\-]+{kept}"), F.lit(0))
    spaced = F.regexp_replace(t, portable(enc.token_pattern), " $1 ")
    pieces = F.split(spaced, f"[{SPACE}]+")
    keep = list(enc.keep_punctuation)
    # One anchored pattern: a word-like piece, or exactly one of the kept strings.
    options = [rf"[{WORD}\-]+"] + ["".join("\\" + c if not c.isalnum() else c for c in p) for p in keep]
    accepted = F.lit("^(?:" + "|".join(options) + r")\z")
    return F.filter(pieces, lambda p: F.rlike(p, accepted))

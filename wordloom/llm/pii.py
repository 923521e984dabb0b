"""Personal data and secrets: format-preserving Feistel pseudonyms.

Numbers that pass their validity check (payment cards, telephone numbers, social security numbers,
IPv4 addresses, IBANs of all countries) and calendar dates, in digits or with the name of the month
in four languages, are permuted within their own format by a keyed Feistel network: the result is
valid again and keeps its separators, and equal values get equal pseudonyms in every document,
however they are punctuated. In an IBAN the letters stay, in an international telephone number the
first two digits. A date keeps its order and language; of dates like 3/4/1990 the first number is
taken for the day if it can be. Mail
addresses and secrets have no number behind them; they get a keyed hash in their own alphabet.

Everything is one projection of DataFrame functions. A text is cut at its matches, the matches are
exchanged, and the parts are joined again; texts without a match pass unchanged.

Null stays null and an empty text stays empty. Numbers that fail their check are left alone.
Repeated rows and values get the same pseudonyms; an empty table gives an empty table; other
columns pass untouched, whatever their names. The work is linear in the length of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import bind, table

ROUNDS = 8
KEY_SETTING = "wordloom.pii.key"  # the session setting that holds the secret for the registered queries

# ── fixed values: the formats ────────────────────────────────────────────────────────────
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ACCESS_KEY = r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"
ASSIGNED = r"\b(?i:token|password|passwd|secret|api_?key)\s*[=:]\s*[\"']?[A-Za-z0-9_\-]{12,}"
DATE = r"(?<![\d/.-])(?:1[7-9]|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\d/-])"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?<![\d+])(?:\+1[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4})(?!\d)"
# Characters of an IBAN by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 "
    "GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 "
    "MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)
IBAN = "\\b(?:" + "|".join(
    f"(?:{'|'.join(c[:2] for c in IBAN_LENGTHS.split() if int(c[2:]) == n)})\\d\\d(?: ?[A-Z0-9]){{{n - 4}}}" for n in sorted({int(c[2:]) for c in IBAN_LENGTHS.split()})
) + ")(?![A-Za-z0-9])"
MONTHS = (
    "january february march april may june july august september october november december "
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre "
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre "
    "januar februar märz april mai juni juli august september oktober november dezember"
).split()
_YEAR, _DAY, _NAME = r"(?:1[7-9]|20)\d\d", r"(?:0?[1-9]|[12]\d|3[01])", "(?iu:" + "|".join(dict.fromkeys(MONTHS)) + ")"
NUMERIC_DATE = rf"(?<![\d/.-]){_DAY}(?:\.{_DAY}\.|/{_DAY}/){_YEAR}(?![\d/-])"
NAMED_DATE = rf"(?<![\w.-])(?:{_DAY}(?:\. | de | ){_NAME}(?: de | ){_YEAR}|{_NAME} {_DAY},? {_YEAR})(?!\w)"
INTERNATIONAL = r"(?<![\d+])\+[2-9](?:[ .-]?\d){7,14}(?![ .-]?\d)"
# A whole run of digit groups, of any length; the cards are looked for inside.
CARD = r"(?<!\d)(?<!\d[.+-])(?=\d(?:[ -]?\d){12})\d++(?:[ -]\d++)*+"
FORMATS = {
    "email": EMAIL, "access_key": ACCESS_KEY, "assigned": ASSIGNED, "iban": IBAN, "date": DATE, "numeric_date": NUMERIC_DATE,
    "named_date": NAMED_DATE, "ip": IP, "ssn": SSN, "phone": PHONE, "international": INTERNATIONAL, "card": CARD,
}
# Two passes; in each the first format that fits at a place wins. The second reads what the first
# left, and the numbers beside a card, with `OPEN index CLOSE` in place of what was exchanged.
FIRST = {k: FORMATS[k] for k in ("email", "access_key", "assigned", "iban", "card")}
SECOND = {k: FORMATS[k] for k in ("date", "numeric_date", "named_date", "ip", "ssn", "phone", "international")}
OPEN = ["\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3", "\ufdd4"]  # noncharacters; the first that a text lacks
CLOSE = "\ufdef"
FIRST_DAY, DAYS = "1700-01-01", (773, 189)  # 146,097 days: the 400 years to 2099-12-31


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _hash(secret: Column, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", secret, F.lit(kind), *[p.cast("string") for p in parts]), 256)


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _padded(n: Column, width: Column | int) -> Column:
    return F.lpad(n.cast("string"), width if isinstance(width, Column) else F.lit(width), F.lit("0"))


def feistel(secret: Column, kind: str, x: Column, y: Column, a: Column, b: Column) -> Column:
    """A keyed permutation of the pairs (x, y) with 0 <= x < a and 0 <= y < b.

    Every round adds a keyed hash of one part to the other, modulo the other's size, so each
    round, and the whole, can be undone with the key.
    """

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        seen = F.when(even, s.y).otherwise(s.x)
        noise = F.conv(F.substring(_hash(secret, kind, a, b, r, seen), 1, 13), 16, 10).cast("long")
        return F.struct(
            F.when(even, F.pmod(s.x + noise, a)).otherwise(s.x).alias("x"),
            F.when(even, s.y).otherwise(F.pmod(s.y + noise, b)).alias("y"),
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _halves(secret: Column, kind: str, d: Column) -> Column:
    """Digits permuted among the digit strings of the same length (2 to 36)."""
    u = F.floor(F.length(d) / 2).cast("int")
    v = F.length(d) - u
    mixed = feistel(secret, kind, F.substring(d, F.lit(1), u).cast("long"), F.substring(d, u + 1, v).cast("long"), _power(u), _power(v))
    return bind(mixed, lambda s: F.concat(_padded(s.x, u), _padded(s.y, v)))


def _luhn(d: Column) -> Column:
    """The Luhn sum of a digit string, its last digit counted once."""
    n = F.length(d)
    twice = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substring(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
    )
    return F.aggregate(twice, F.lit(0), lambda t, x: t + F.when(x > 9, x - 9).otherwise(x))


def _mod97(d: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda t, i: (t * 10 + F.substring(d, i, F.lit(1)).cast("int")) % 97)


def _refilled(x: Column, digits: Column) -> Column:
    """The template `x` with its digits, in order, exchanged for `digits`."""
    parts = F.transform(
        F.sequence(F.lit(1), F.length(x)),
        lambda i: bind(F.substring(x, i, F.lit(1)), lambda c: F.when(
            c.between("0", "9"), F.substring(digits, F.length(_digits(F.substring(x, F.lit(1), i))), F.lit(1))
        ).otherwise(c)),
    )
    return F.array_join(parts, "")


# ── one function per format: the pseudonym, or null if the value fails its check ─────────


def _card(secret: Column, x: Column) -> Column:
    def made(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), _halves(secret, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
        return bind(body, lambda p: F.concat(p, F.pmod(F.lit(10) - _luhn(F.concat(p, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    return bind(_digits(x), lambda d: F.when(_luhn(d) % 10 == 0, _refilled(x, made(d))))


SPOTS = "array<struct<a:int,b:int>>"
SIZES = (16, 15, 19, 18, 17, 14, 13)  # digits of a card, the likeliest first
CHUNK = 512


def _card_spots(x: Column) -> Column:
    """Where cards stand in a run of digit groups: (first group, last group), in order.

    Every stretch of whole groups with 13 to 19 digits that passes Luhn is a candidate. The whole run
    comes first, then 16 digits, 15, and the others; of overlapping ones the first stays. Sizes are
    settled one after the other, each by one walk from left to right, so the work is linear.
    """

    def found(g: Column) -> Column:
        n = F.size(g)

        def at(i: Column) -> Column:
            ends = F.sequence(i, F.least(i + 18, n - 1))
            digits = lambda j: F.array_join(F.slice(g, i + 1, j - i + 1), "")

            def spot(j: Column) -> Column:
                """The candidate from group i to j; of size 0 if it is none."""
                sized = lambda d: F.when(F.length(d).between(13, 19) & (_luhn(d) % 10 == 0), F.length(d)).otherwise(0)
                return F.struct(bind(digits(j), sized).cast("int").alias("size"), i.cast("int").alias("a"), j.cast("int").alias("b"))

            return F.filter(F.transform(ends, spot), lambda c: c.size > 0)

        every = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), at))
        return bind(every, lambda c: F.when(F.size(c) == 0, _none()).otherwise(settled(c)))

    def settled(every: Column) -> Column:
        whole = F.filter(every, lambda c: (c.a == 0) & (c.b == F.size(F.split(x, "[ -]")) - 1))
        start = F.transform(whole, lambda c: F.struct(c.a.alias("a"), c.b.alias("b")))
        return F.when(F.size(start) > 0, start).otherwise(F.aggregate(F.array(*map(F.lit, SIZES)), _none(), lambda kept, size: add(every, kept, size)))

    def add(every: Column, kept: Column, size: Column) -> Column:
        """`kept` with the candidates of one size that find room, the leftmost first."""
        fits = F.filter(every, lambda c: c.size == size)
        free = lambda busy: F.filter(fits, lambda c: ~F.exists(F.slice(busy, c.a + 1, c.b - c.a + 1), lambda t: t))
        join = lambda new: F.array_sort(F.concat(kept, new))
        return F.when(F.size(fits) == 0, kept).otherwise(bind(_busy(kept), lambda busy: bind(_leftmost(free(busy)), join)))

    return bind(F.split(x, "[ -]"), found)


def _none() -> Column:
    return F.array().cast(SPOTS)


def _busy(kept: Column) -> Column:
    """Which groups the spots, in order, take; as far as the last of them."""
    gap = lambda k, i: k.a - F.when(i == 0, 0).otherwise(F.get(kept, i - 1).b + 1)
    return F.flatten(F.transform(kept, lambda k, i: F.concat(F.array_repeat(F.lit(False), gap(k, i)), F.array_repeat(F.lit(True), k.b - k.a + 1))))


def _leftmost(spots: Column) -> Column:
    """Spots in order without those that overlap one before them that stays. Walked in chunks, so
    that lists are not copied once per spot."""

    def one(state: Column, c: Column) -> Column:
        taken = F.struct(c.b.alias("last"), F.concat(state.kept, F.array(F.struct(c.a.alias("a"), c.b.alias("b")))).alias("kept"))
        return F.when(c.a > state.last, taken).otherwise(state)

    def chunk(state: Column, at: Column) -> Column:
        fresh = F.struct(state.last.alias("last"), _none().alias("kept"))
        walked = F.aggregate(F.slice(spots, at, CHUNK), fresh, one)
        return bind(walked, lambda w: F.struct(w["last"].alias("last"), F.concat(state.kept, w.kept).alias("kept")))

    start = F.struct(F.lit(-1).alias("last"), _none().alias("kept"))
    chunks = F.sequence(F.lit(1), F.greatest(F.size(spots), F.lit(1)), F.lit(CHUNK))
    return F.aggregate(chunks, start, chunk, lambda state: state.kept)


PIECE = "struct<raw:string,kind:string,made:string>"


def _piece(raw: Column, kind: Column | None = None, made: Column | None = None) -> Column:
    return F.struct(raw.alias("raw"), *[(F.lit(None) if c is None else c).cast("string").alias(n) for c, n in ((kind, "kind"), (made, "made"))]).cast(PIECE)


def _cards(secret: Column, x: Column) -> Column:
    """A run of digit groups as pieces: its cards, exchanged, and the numbers beside them."""

    def cut(spots: Column) -> Column:
        return F.when(F.size(spots) == 0, F.array(_piece(x))).otherwise(bind(F.regexp_extract_all(x, F.lit(r"(\d+[ -]?)"), F.lit(1)), lambda groups: parts(groups, spots)))

    def parts(groups: Column, spots: Column) -> Column:
        """`groups` keep the separator behind them; that of a card's last group goes to the next gap."""
        text = lambda lo, hi: F.array_join(F.slice(groups, lo + 1, hi - lo), "")
        behind = lambda k: F.regexp_extract(F.get(groups, k.b), "[ -]$", 0)
        gap = lambda k, hi: F.concat(behind(k), text(k.b + 1, hi))

        def one(k: Column, i: Column) -> Column:
            before = F.when(i == 0, text(F.lit(0), k.a)).otherwise(gap(F.get(spots, i - 1), k.a))
            card = F.regexp_replace(text(k.a, k.b + 1), "[ -]$", "")
            return F.array(_piece(before), bind(card, lambda c: _piece(c, F.lit("card"), _card(secret, c))))

        tail = gap(F.get(spots, F.size(spots) - 1), F.size(groups))
        return F.concat(F.flatten(F.transform(spots, one)), F.array(_piece(tail)))

    return bind(_card_spots(x), cut)


def _iban(secret: Column, x: Column) -> Column:
    bare = F.replace(x, F.lit(" "), F.lit(""))

    def numbers(text: Column) -> Column:
        """Letters as the numbers from 10 on."""
        letter = lambda c: F.when(c.between("0", "9"), c).otherwise((F.ascii(c) - 55).cast("string"))
        return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), letter), "")

    def made(all_: Column) -> Column:
        head, body = F.substring(all_, 1, 2), F.substring(all_, F.lit(5), F.length(all_) - 4)
        fresh = bind(_digits(body), lambda d: F.when(F.length(d) < 2, d).otherwise(_halves(secret, "iban", d)))

        def checked(f: Column) -> Column:
            rest = _mod97(numbers(F.concat(_refilled(body, f), head, F.lit("00"))))
            return F.concat(_padded(F.lit(98) - rest, 2), f)

        return bind(fresh, checked)

    valid = lambda b: _mod97(numbers(F.concat(F.substring(b, F.lit(5), F.length(b) - 4), F.substring(b, 1, 4)))) == 1
    return bind(bare, lambda b: F.when(valid(b), _refilled(x, made(b))))


def _international(secret: Column, x: Column) -> Column:
    """The first two digits stay: most of the country code."""
    return bind(_digits(x), lambda d: _refilled(x, F.concat(F.substring(d, 1, 2), _halves(secret, "international", F.substring(d, F.lit(3), F.length(d) - 2)))))


def _phone(secret: Column, x: Column) -> Column:
    def made(d: Column) -> Column:
        ten = F.right(d, F.lit(10))
        area, office, line = F.substring(ten, 1, 3).cast("long"), F.substring(ten, 4, 3).cast("long"), F.substring(ten, 7, 4).cast("long")
        # Area and office codes from 200 on; numbers outside keep to their own kind.
        low_area, low_office = F.when(area < 200, 0).otherwise(200), F.when((area >= 200) & (office >= 200), 200).otherwise(0)
        offices = F.when(area < 200, 1000).when(office < 200, 200).otherwise(800)
        mixed = feistel(
            secret, "phone", area - low_area, (office - low_office) * 10000 + line,
            F.when(area < 200, 200).otherwise(800).cast("long"), (offices * 10000).cast("long"),
        )
        fresh = bind(mixed, lambda s: F.concat(_padded(s.x + low_area, 3), _padded(s.y + low_office * 10000, 7)))
        return F.concat(F.substring(d, F.lit(1), F.length(d) - 10), fresh)

    return bind(_digits(x), lambda d: _refilled(x, made(d)))


def _ssn(secret: Column, x: Column) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    area, group, serial = F.substring(x, 1, 3).cast("long"), F.substring(x, 5, 2).cast("long"), F.substring(x, 8, 4).cast("long")
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    mixed = feistel(secret, "ssn", place, (group - 1) * 9999 + serial - 1, _long(898), _long(99 * 9999))

    def shown(s: Column) -> Column:
        back = s.x + 1 + F.when(s.x >= 665, 1).otherwise(0)
        low = F.pmod(s.y, _long(9999))
        return F.concat(_padded(back, 3), F.lit("-"), _padded(((s.y - low) / 9999 + 1).cast("long"), 2), F.lit("-"), _padded(low + 1, 4))

    return F.when(valid, bind(mixed, shown))


def _ip(secret: Column, x: Column) -> Column:
    def made(o: Column) -> Column:
        n = [F.get(o, F.lit(i)).cast("long") for i in range(4)]
        mixed = feistel(secret, "ip", n[0] * 256 + n[1], n[2] * 256 + n[3], _long(65536), _long(65536))
        octets = lambda s: [F.shiftright(s.x, 8), s.x.bitwiseAND(255), F.shiftright(s.y, 8), s.y.bitwiseAND(255)]
        return F.when(~F.exists(o, lambda v: v.cast("int") > 255), bind(mixed, lambda s: F.concat_ws(".", *[v.cast("string") for v in octets(s)])))

    return bind(F.split(x, r"\."), made)


def _moved(secret: Column, day: Column) -> Column:
    """Another day of the calendar from 1700 to 2099; null stays null."""
    a, b = DAYS

    def made(n: Column) -> Column:
        low = F.pmod(n, _long(b))
        mixed = feistel(secret, "date", ((n - low) / b).cast("long"), low, _long(a), _long(b))
        return F.when(n.isNotNull(), bind(mixed, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s.x * b + s.y).cast("int"))))

    return bind(F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long"), made)


def _calendar(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where the calendar has none."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _like(value: Column, old: Column) -> Column:
    """A day or month as wide as the old one was written: with a leading zero or without."""
    return F.when(F.length(old) == 2, F.lpad(value.cast("string"), 2, "0")).otherwise(value.cast("string"))


def _date(secret: Column, x: Column) -> Column:
    return bind(_moved(secret, F.try_to_date(x, "yyyy-MM-dd")), lambda d: F.date_format(d, "yyyy-MM-dd"))


def _numeric_date(secret: Column, x: Column) -> Column:
    def made(p: Column) -> Column:
        one, two, year = (F.get(p, F.lit(i)) for i in range(3))
        mark = F.substring(x, F.length(one) + 1, F.lit(1))
        day_first, month_first = _calendar(year, two, one), F.when(mark == "/", _calendar(year, one, two))
        flipped = day_first.isNull()

        def shown(d: Column) -> Column:
            first, second = F.when(flipped, F.month(d)).otherwise(F.day(d)), F.when(flipped, F.day(d)).otherwise(F.month(d))
            return F.when(d.isNotNull(), F.concat(_like(first, one), mark, _like(second, two), mark, F.year(d).cast("string")))

        return bind(_moved(secret, F.coalesce(day_first, month_first)), shown)

    return bind(F.split(x, "[./]"), made)


def _named_date(secret: Column, x: Column) -> Column:
    """Day, month, year, or month, day, year; the new month is named in the same language."""
    names = F.array(*map(F.lit, MONTHS))
    begins = x.rlike(r"^\d")
    name = F.regexp_extract(x, f"({_NAME})", 1)
    day, year = F.regexp_extract(x, r"(?<!\d)(\d{1,2})(?!\d)", 1), F.right(x, F.lit(4))

    def made(at: Column) -> Column:
        def shown(d: Column) -> Column:
            plain = F.get(names, at - at % 12 + F.month(d) - 1)
            said = F.when(F.upper(name) == name, F.upper(plain)).when(F.substring(F.lower(name), 1, 1) == F.substring(name, 1, 1), plain).otherwise(F.initcap(plain))
            fresh, between = _like(F.day(d), day), lambda i: F.regexp_extract(x, f"^(?:\\d+|{_NAME})(\\D+?)(?:{_NAME}|\\d+)(\\D+)\\d+$", i)
            return F.when(d.isNotNull(), F.concat(F.when(begins, fresh).otherwise(said), between(1), F.when(begins, said).otherwise(fresh), between(2), F.year(d).cast("string")))

        return bind(_moved(secret, _calendar(year, (at % 12 + 1).cast("string"), day)), shown)

    # Names that two languages share: a point behind the day is German.
    german = F.when(x.rlike(r"^\d{1,2}\.") & F.array_contains(F.slice(names, 37, 12), F.lower(name)), F.array_position(F.slice(names, 37, 12), F.lower(name)) + 36)
    return bind(F.coalesce(german, F.array_position(names, F.lower(name))).cast("int") - 1, made)


def _email(secret: Column, x: Column) -> Column:
    return F.concat(F.substring(_hash(secret, "email", F.lower(x)), 1, 16), F.lit("@example.invalid"))


def _access_key(secret: Column, x: Column) -> Column:
    return F.concat(F.substring(x, 1, 4), F.upper(F.substring(_hash(secret, "access_key", x), 1, 16)))


def _assigned(secret: Column, x: Column) -> Column:
    name = F.regexp_extract(x, r"^(\w+\s*[=:]\s*[\"']?)", 1)
    value = F.substring(x, F.length(name) + 1, F.length(x))
    return bind(value, lambda v: F.concat(name, F.rpad(_hash(secret, "assigned", v), F.length(v), _hash(secret, "more", v))))


MAKERS = {
    "email": _email, "access_key": _access_key, "assigned": _assigned, "iban": _iban, "date": _date, "numeric_date": _numeric_date,
    "named_date": _named_date, "ip": _ip, "ssn": _ssn, "phone": _phone, "international": _international, "card": _card,
}


def _any(formats: dict[str, str]) -> str:
    return "|".join(f"(?:{p})" for p in formats.values())


def _exchange(secret: Column, x: Column, formats: dict[str, str]) -> Column:
    """A match as a piece: its format and its pseudonym; both null if its check fails."""
    chosen = _piece(x)
    for kind, pattern in reversed(formats.items()):
        made = bind(MAKERS[kind](secret, x), lambda m: F.when(m.isNotNull(), _piece(x, F.lit(kind), m)).otherwise(_piece(x)))  # noqa: B023
        chosen = F.when(x.rlike(f"^(?:{pattern})$"), made).otherwise(chosen)
    return chosen


def _woven(gaps: Column, pieces: Column) -> Column:
    """Gaps and lists of pieces in turn, as one list of pieces."""
    return F.flatten(F.zip_with(gaps, pieces, lambda g, p: F.concat(F.array(_piece(g)), F.coalesce(p, F.array().cast(f"array<{PIECE}>")))))


def session_key(spark) -> str:
    """The secret of the session. Without one a public text takes its place, for trials only: whoever
    knows the key can undo the pseudonyms."""
    return spark.conf.get(KEY_SETTING, None) or "for trials only"


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(row, pii): the input row as a struct, and STRUCT(text, kinds): the text with pseudonyms
    and the kind of every exchanged value, in order."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    t = F.col("row").getField(text)
    secret = F.lit(key)
    one = _any(FIRST)
    run = lambda x: x.rlike(r"^\d[\d -]+$")
    rest = {k: p for k, p in FIRST.items() if k != "card"}
    df = df.withColumn("_m", F.regexp_extract_all(t, F.lit(f"({one})"), F.lit(1)))
    df = df.withColumn("_p", F.transform("_m", lambda x: F.when(run(x), _cards(secret, x)).otherwise(F.array(_exchange(secret, x, rest)))))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, _woven(F.split(t, one), F.col("_p"))).otherwise(F.array(_piece(t))))
    opening = F.coalesce(*[F.when(~F.contains(t, F.lit(c)), F.lit(c)) for c in OPEN], F.lit(OPEN[0]))
    left = lambda p, i: F.when(p.made.isNull(), p.raw).otherwise(F.concat(opening, i.cast("string"), F.lit(CLOSE)))
    df = df.withColumn("_t", F.when(t.isNull(), t).otherwise(F.array_join(F.transform("_p", left), "")))
    two = f"[{OPEN[0]}-{OPEN[-1]}]\\d+{CLOSE}|{_any(SECOND)}"
    df = df.withColumn("_n", F.regexp_extract_all("_t", F.lit(f"({two})"), F.lit(1)))
    put = lambda x: F.when(
        (F.substring(x, 1, 1) == opening) & (F.right(x, F.lit(1)) == CLOSE), F.get("_p", F.regexp_extract(x, r"\d+", 0).cast("int"))
    ).otherwise(_exchange(secret, x, SECOND))
    df = df.withColumn("_x", F.transform("_n", put))
    fresh = F.transform("_x", lambda x: F.coalesce(x.made, x.raw))
    joined = F.array_join(F.flatten(F.zip_with(F.split("_t", two), fresh, lambda g, m: F.array(g, F.coalesce(m, F.lit(""))))), "")
    kinds = F.transform(F.filter("_x", lambda x: x.made.isNotNull()), lambda x: x.kind)
    out = F.when(t.isNull() | (F.size("_n") == 0), t).otherwise(joined)
    return df.select("row", F.struct(out.alias("text"), F.coalesce(kinds, F.array().cast("array<string>")).alias("kinds")).alias("pii"))


def op7_pii(spark, sf: str) -> DataFrame:
    """One row per document: its text with pseudonyms, and how many values of which kinds."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kinds = F.col("pii.kinds")
    counts = [F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in FORMATS]  # noqa: B023
    return pseudonymised(docs, session_key(spark)).select("row.doc_id", "pii.text", F.size(kinds).cast("long").alias("n_found"), *counts)

"""Operator 9: format-preserving Feistel pseudonyms for personal data, DataFrame functions only.

Recognised and validated: e-mail addresses, IPv4 addresses (four octets), payment cards (13 to 19 digits with a right check
digit), telephone numbers (7 or 10 digits with separators, after an optional country code) and calendar dates from 1800 to
2199 (yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, mm/dd/yyyy).  Each value is replaced by a keyed permutation of the values of its own format:
a Feistel network of eight rounds over its two halves, with SHA-256 of key, kind, round and other half as round function.
Digits stay digits in their places, a card gets the right check digit, an address stays an address and a date a
date (the 400 years are 773 * 189 days, so both halves are whole), letters of a mailbox stay letters of their case.
The permutation depends on the key alone, so equal values stay linked across documents and different values stay
apart; numbers and dates are linked across their separators.

Cards are looked for first, in texts with a chain of 13 digits only: every place where a usual grouping may begin (no separator, 4-4-4-4
with or without three more, 4-6-4, 4-6-5) is a candidate, overlapping ones included, and those with a right check digit are
marked, the leftmost first, longer ones before shorter; another grouping counts if its whole chain passes and holds no usual
card.  What is not marked is then searched for the other kinds in one pass, so numbers beside a card or in a chain that is
none are found like anywhere else.

Edge cases: null text stays null, text without such values stays as it is; invalid look-alikes (a wrong check digit, 30
February) stay; repeated rows and rows of null doc_id are treated each; other columns pass through, but one named like the
result's ``pii`` (``found``) gives way to it; very long texts are searched whole (patterns are possessive or bounded: no recursion over
the text's length); characters used as marks are escaped while they are; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
        r"|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])")
PHONE = (r"(?<![0-9A-Za-z-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])?[0-9]{3}[ .-][0-9]{4}"
         r"(?![0-9-])")
CHAIN = r"[0-9](?:[ -]?[0-9]){12}"
#: Candidates for cards; a spaced grouping does not begin within a hyphenated number, and a mailbox is no card.
_END = r"(?![0-9])(?![A-Za-z0-9._%+-]{0,64}+@)"
CARDS = (rf"(?<![0-9])[0-9]{{13,19}}{_END}",
         *(rf"(?<![0-9])(?<![0-9]-)[0-9]{{4}}(?: [0-9]{{4}}){{3}}{x}{_END}" for x in ("", " [0-9]{3}")),
         *(rf"(?<![0-9])(?<![0-9]-)[0-9]{{4}} [0-9]{{6}} [0-9]{{{n}}}{_END}" for n in (4, 5)),
         *(rf"(?<![0-9])[0-9]{{4}}(?:-[0-9]{{4}}){{3}}{x}{_END}" for x in ("", "-[0-9]{3}")),
         *(rf"(?<![0-9])[0-9]{{4}}-[0-9]{{6}}-[0-9]{{{n}}}{_END}" for n in (4, 5)))
UNUSUAL = (rf"(?<![0-9])(?<![0-9][ -])(?=[0-9](?:[ -]?[0-9]){{12,18}}(?![ -]?[0-9]))"
           rf"[0-9]{{1,18}}([ -])[0-9]{{1,18}}(?:\2[0-9]{{1,18}}){{0,17}}+(?![ -]?[0-9]){_END}")
#: Marks around found values and found cards, and the escape for texts that hold them.
MARK, CARD, ESCAPE = "￿", "﷒", "￾"
_CODES = ((ESCAPE, ESCAPE + "﷐"), (MARK, ESCAPE + "﷑"), (CARD, ESCAPE + "﷓"))
_NUMBERS = f"(?=[0-9+(])(?:{IPV4}|{DATE}|{PHONE})|{CARD}[0-9 -]+{CARD}"
_ALL = f"{EMAIL}|{_NUMBERS}"
KINDS = ("email", "ipv4", "date", "card", "phone")
_FORMATS = ((r"^[0-9]{4}-", "yyyy-MM-dd"), (r"^[0-9]{4}/", "yyyy/MM/dd"), (r"^[0-9]{2}\.", "dd.MM.yyyy"),
            (r"^[0-9]{2}/", "MM/dd/yyyy"))


def _let(value: Column, then) -> Column:
    """then(value), with the value computed once and named (columns are copied wherever they are used)."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _digest(key: str, kind: str, r: Column, size: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), size.cast("string"), other), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _rounds(start: Column, step, finish=None) -> Column:
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, *([finish] if finish else []))


def _feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: str, finish) -> Column:
    """finish(struct(a, b, p, q)): a pair of numbers below p and q, permuted."""
    def step(x, r):
        even = r % 2 == 0
        other = F.when(even, x.b).otherwise(x.a).cast("string")
        return _let(_number(_digest(key, kind, r, x.p * x.q, other)), lambda f: F.struct(
            F.when(even, F.pmod(x.a + f, x.p)).otherwise(x.a).alias("a"),
            F.when(even, x.b).otherwise(F.pmod(x.b + f, x.q)).alias("b"), x.p.alias("p"), x.q.alias("q")))
    start = F.struct(*[c.cast("long").alias(n) for c, n in ((a, "a"), (b, "b"), (size_a, "p"), (size_b, "q"))])
    return _rounds(start, step, finish)


def _digits(s: Column, key: str, kind: str) -> Column:
    """A string of 2 to 18 digits, permuted among those of its length."""
    def halves(s):
        u, v = F.length(s) - F.floor(F.length(s) / 2).cast("int"), F.floor(F.length(s) / 2).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
        return _feistel(F.substr(s, F.lit(1), u), F.substr(s, u + 1), ten(u), ten(v), key, kind, lambda x: F.concat(
            F.lpad(x.a.cast("string"), u, F.lit("0")), F.lpad(x.b.cast("string"), v, F.lit("0"))))
    return _let(s, halves)


def _only_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column, odd: int) -> Column:
    """The check sum; every second digit from the right is doubled, from the last (odd 0) or the one before it (1)."""
    total = F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda t, i: t + _let(
        F.substr(s, i, F.lit(1)).cast("int"), lambda d: _doubled(d, (F.length(s) - i) % 2 == odd)))
    return F.pmod(total, F.lit(10))


def _doubled(d: Column, yes: Column) -> Column:
    return F.when(~yes, d).when(d > 4, 2 * d - 9).otherwise(2 * d)


def _into(shape: Column, digits: Column) -> Column:
    """The digits put in the places of the digits of ``shape``."""
    def one(x, c):
        digit = c.between("0", "9")
        return F.struct(F.concat(x.out, F.when(digit, F.substr(digits, x.k, F.lit(1))).otherwise(c)).alias("out"),
                        F.when(digit, x.k + 1).otherwise(x.k).alias("k"))
    return F.aggregate(F.split(shape, "(?!^)"), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), one, lambda x: x.out)


def _card(m: Column, key: str) -> Column:
    def whole(s):
        return _let(_digits(F.substr(s, F.lit(1), F.length(s) - 1), key, "card"), lambda body: _let(
            F.concat(body, F.pmod(10 - _luhn(body, 0), F.lit(10)).cast("string")), lambda d: _into(m, d)))
    return _let(_only_digits(m), whole)


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^\+[0-9]{1,3}[ .-]?(?=[(0-9])", 0)
    return _let(country, lambda c: F.concat(c, _let(F.substr(m, F.length(c) + 1), lambda rest: _let(
        _digits(_only_digits(rest), key, "phone"), lambda d: _into(rest, d)))))


def _ipv4(m: Column, key: str) -> Column:
    o = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    n = F.lit(65536).cast("long")
    return _feistel(o(1) * 256 + o(2), o(3) * 256 + o(4), n, n, key, "ipv4", lambda p: F.concat_ws(
        ".", F.floor(p.a / 256).cast("string"), (p.a % 256).cast("string"), F.floor(p.b / 256).cast("string"),
        (p.b % 256).cast("string")))


def _as_date(m: Column) -> Column:
    d = F.coalesce(*[F.when(m.rlike(r), F.try_to_date(m, f)) for r, f in _FORMATS])
    return _let(d, lambda d: F.when((d >= F.lit("1800-01-01").cast("date")) & (d < F.lit("2200-01-01").cast("date")), d))


def _date(m: Column, key: str) -> Column:
    first = F.lit("1800-01-01").cast("date")

    def moved(day):
        return _let(_feistel(F.floor(day / 189), day % 189, F.lit(773), F.lit(189), key, "date",
                             lambda p: F.date_add(first, (p.a * 189 + p.b).cast("int"))),
                    lambda d: F.coalesce(*[F.when(m.rlike(r), F.date_format(d, f)) for r, f in _FORMATS]))
    return _let(F.datediff(_as_date(m), first), moved)


def _shift(s: Column, digest: Column) -> Column:
    """Letters and digits moved within their class by the digest's bytes."""
    def one(c, i):
        k = F.conv(F.substr(digest, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int")
        move = lambda first, size: F.char(F.pmod(F.ascii(c) - first + k, F.lit(size)) + first)
        return (F.when(c.between("a", "z"), move(97, 26)).when(c.between("A", "Z"), move(65, 26))
                .when(c.between("0", "9"), move(48, 10)).otherwise(c))
    return F.array_join(F.transform(F.split(s, "(?!^)"), one), "")


def _email(m: Column, key: str) -> Column:
    def step(x, r):
        even = r % 2 == 0
        d = _digest(key, "email", r, F.length(x.a) + F.length(x.b), F.when(even, x.b).otherwise(x.a))
        return _let(d, lambda d: _let(_shift(F.when(even, x.a).otherwise(x.b), d), lambda new: F.struct(
            F.when(even, new).otherwise(x.a).alias("a"), F.when(even, x.b).otherwise(new).alias("b"))))

    def whole(box):
        u = F.ceil(F.length(box) / 2).cast("int")
        return _rounds(F.struct(F.substr(box, F.lit(1), u).alias("a"), F.substr(box, u + 1).alias("b")), step,
                       lambda p: F.concat(p.a, p.b, F.lit("@"), F.substring_index(m, "@", -1)))
    return _let(F.substring_index(m, "@", 1), whole)


def _valid_cards(t: Column) -> Column:
    """The strings of ``t`` that count as cards (digits, spaces and hyphens only), longer ones first."""
    found = lambda p, g: F.regexp_extract_all(t, F.lit(f"(?=({p}))"), F.lit(g))
    right = lambda xs: F.filter(F.array_distinct(xs), lambda x: _let(
        _only_digits(x), lambda s: F.length(s).between(13, 19) & (_luhn(s, 1) == 0)))
    usual = right(F.concat(*[found(p, 1) for p in CARDS]))
    other = right(found(UNUSUAL, 1))
    both = _let(usual, lambda u: F.concat(u, F.filter(other, lambda x: ~F.exists(u, lambda v: F.contains(x, v)))))
    longest = F.sort_array(F.transform(both, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))), False)
    return F.transform(longest, lambda s: s.x)


def _with_cards_marked(t: Column) -> Column:
    def marked(cards):
        one = F.concat(F.lit("(?<![0-9])(?:"), F.array_join(cards, "|"), F.lit(")(?![0-9])"))
        return F.when(F.size(cards) > 0, F.regexp_replace(t, one, F.lit(f"{CARD}$0{CARD}"))).otherwise(t)
    return F.when(t.rlike(CHAIN), _let(_valid_cards(t), marked)).otherwise(t)


def _escaped(t: Column) -> Column:
    some = F.lit(False)
    out = t
    for c, code in _CODES:
        some = some | F.contains(t, F.lit(c))
        out = F.replace(out, F.lit(c), F.lit(code))
    return F.when(some, out).otherwise(t)


def _unescaped(t: Column) -> Column:
    out = t
    for c, code in reversed(_CODES):
        out = F.replace(out, F.lit(code), F.lit(c))
    return F.when(F.contains(t, F.lit(ESCAPE)), out).otherwise(t)


def kind_of(m: Column) -> Column:
    """The kind of a found value, null if it fails validation."""
    return (F.when(m.startswith(CARD), F.lit("card")).when(m.contains("@"), F.lit("email"))
            .when(m.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$"), F.lit("ipv4"))
            .when(m.rlike(r"^[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}$|^[0-9]{2}[./][0-9]{2}[./][0-9]{4}$"),
                  F.when(_as_date(m).isNotNull(), F.lit("date")))
            .otherwise(F.lit("phone")))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    return (F.when(kind == "email", _email(m, key)).when(kind == "ipv4", _ipv4(m, key))
            .when(kind == "date", _date(m, key)).when(kind == "card", _let(F.replace(m, F.lit(CARD), F.lit("")), lambda c: _card(c, key)))
            .when(kind == "phone", _phone(m, key)).otherwise(m))


def pseudonymised(docs: DataFrame, key: str, text: str = "text", found: str = "pii") -> DataFrame:
    """docs with personal values of ``text`` replaced, and ``found`` array<struct<kind, value>> of the pseudonyms put in."""
    keep = [c for c in docs.columns if c.lower() != found.lower()]
    own = lambda name: f"{name}_{uuid.uuid4().hex}"  # noqa: E731 (clashes with no column)
    marked, parts = own("marked"), own("parts")
    t = F.col(f"`{text}`").cast("string")
    # cards are marked in a column of its own, then one pass marks all other values
    x = docs.select(*[F.col(f"`{c}`") for c in keep], F.when(t.rlike("[0-9@]"), _let(_escaped(t), _with_cards_marked)).alias(marked))
    once = lambda p: F.regexp_replace(F.col(marked), p, f"{MARK}$0{MARK}")
    cut = F.split(F.when(F.contains(F.col(marked), F.lit("@")), once(_ALL)).otherwise(once(_NUMBERS)), MARK, -1)
    value = lambda m: _let(kind_of(m), lambda k: F.struct(k.alias("kind"), pseudonym(m, k, key).alias("value")))
    plain = lambda s: F.struct(F.lit(None).cast("string").alias("kind"), s.alias("value"))
    every = F.transform(cut, lambda s, i: F.when(i % 2 == 1, value(s)).otherwise(plain(s)))
    x = x.withColumn(parts, F.when(F.col(marked).isNotNull(), every))
    whole = _unescaped(F.array_join(F.transform(parts, lambda v: v.value), ""))
    text_out = F.when(F.size(parts) > 1, whole).otherwise(t).alias(text)
    empty = F.array().cast("array<struct<kind:string,value:string>>")
    return x.select(*[text_out if c == text else F.col(f"`{c}`") for c in keep],
                    F.coalesce(F.filter(parts, lambda v: v.kind.isNotNull()), empty).alias(found))


def count_of(kind: str, found: str = "pii") -> Column:
    return F.size(F.filter(found, lambda v: v.kind == kind)).cast("long")

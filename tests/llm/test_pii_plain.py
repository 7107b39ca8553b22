"""Pseudonyms against a plain finder and a plain Feistel network; awkward, long and clashing inputs."""

import datetime
import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from cohortcast.llm import pii

KEY = "k"
FIRST = datetime.date(1800, 1, 1)
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
BOX = "[A-Za-z0-9._%+-]"


# ---- a plain Feistel network ---------------------------------------------------------------------------

def number(kind, r, size, other):
    text = "|".join([KEY, kind, str(r), str(size), str(other)])
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def feistel(a, b, p, q, kind):
    for r in range(8):
        if r % 2 == 0:
            a = (a + number(kind, r, p * q, b)) % p
        else:
            b = (b + number(kind, r, p * q, a)) % q
    return a, b


def digits(s, kind):
    v = len(s) // 2
    u = len(s) - v
    a, b = feistel(int(s[:u]), int(s[u:]), 10 ** u, 10 ** v, kind)
    return f"{a:0{u}d}{b:0{v}d}"


def into(shape, new):
    new = iter(new)
    return "".join(next(new) if c in "0123456789" else c for c in shape)


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10


def hidden_card(m):
    s = re.sub("[^0-9]", "", m)
    body = digits(s[:-1], "card")
    return into(m, body + str(-luhn(body + "0") % 10))


def hidden_phone(m):
    c = re.match(r"\+[0-9]{1,3}[ .-]?(?=[(0-9])", m)
    c = c.group() if c else ""
    return c + into(m[len(c):], digits(re.sub("[^0-9]", "", m[len(c):]), "phone"))


def hidden_ipv4(m):
    w, x, y, z = map(int, m.split("."))
    a, b = feistel(w * 256 + x, y * 256 + z, 65536, 65536, "ipv4")
    return f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"


FORMATS = {r"[0-9]{4}-.*": "%Y-%m-%d", r"[0-9]{4}/.*": "%Y/%m/%d", r"[0-9]{2}\..*": "%d.%m.%Y", r"[0-9]{2}/.*": "%m/%d/%Y"}


def hidden_date(m):
    form = next(f for r, f in FORMATS.items() if re.fullmatch(r, m))
    try:
        day = (datetime.datetime.strptime(m, form).date() - FIRST).days
    except ValueError:
        return None
    if not 0 <= day < 146097:
        return None
    a, b = feistel(day // 189, day % 189, 773, 189, "date")
    return (FIRST + datetime.timedelta(a * 189 + b)).strftime(form)


def hidden_email(m):
    box, _, domain = m.partition("@")
    u = -(-len(box) // 2)
    halves = [box[:u], box[u:]]
    for r in range(8):
        text = "|".join([KEY, "email", str(r), str(len(box)), halves[1 - r % 2]])
        d, out = hashlib.sha256(text.encode()).hexdigest(), ""
        for i, c in enumerate(halves[r % 2]):
            k = int(d[2 * (i % 32):2 * (i % 32) + 2], 16)
            for first, size in (("a", 26), ("A", 26), ("0", 10)):
                if first <= c < chr(ord(first) + size):
                    c = chr((ord(c) - ord(first) + k) % size + ord(first))
                    break
            out += c
        halves[r % 2] = out
    return "".join(halves) + "@" + domain


# ---- a plain finder ------------------------------------------------------------------------------------

GROUPINGS = [[n] for n in range(13, 20)] + [[4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 4], [4, 6, 5]]


def cards(t):
    """(start, end) of the cards: the leftmost first, the longest of those that begin at a place."""
    chains = [(m.start(), m.group()) for m in re.finditer(r"[0-9]+(?:[ -][0-9]+)*", t)]
    usual, other = set(), set()
    for base, chain in chains:
        groups = [(m.start(), m.group()) for m in re.finditer("[0-9]+", chain)]
        for i in range(len(groups)):
            for sizes in GROUPINGS:
                run = groups[i:i + len(sizes)]
                if [len(g) for _, g in run] != sizes:
                    continue
                s, e = run[0][0], run[-1][0] + len(run[-1][1])
                seps = set(re.sub("[0-9]", "", chain[s:e]))
                if len(seps) > 1 or luhn(re.sub("[^0-9]", "", chain[s:e])):
                    continue
                if " " in seps and s and chain[s - 1] == "-":
                    continue
                if not re.match(BOX + r"{0,64}@", t[base + e:]) and not re.match(r"-?" + BOX + "{0,63}@", t[base + e:]):
                    usual.add(chain[s:e])
        whole = re.sub("[^0-9]", "", chain)
        if len(groups) > 1 and 13 <= len(whole) <= 19 and len(set(re.sub("[0-9]", "", chain))) == 1 and luhn(whole) == 0 \
                and not re.match(BOX + r"{0,64}@", t[base + len(chain):]):
            other.add(chain)
    good = usual | {x for x in other if not any(u in x for u in usual)}
    at, out = 0, []
    while at < len(t):
        here = [x for x in good if t.startswith(x, at) and not t[at - 1:at].isdigit() * bool(at)
                and not t[at + len(x):at + len(x) + 1].isdigit()]
        if here:
            x = max(here, key=len)
            out.append((at, at + len(x)))
            at += len(x)
        else:
            at += 1
    return out


REST = [("email", rf"(?<!{BOX}){BOX}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", hidden_email),
        ("ipv4", rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9])", hidden_ipv4),
        ("date", r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
                 r"|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/-])", hidden_date),
        ("phone", r"(?<![0-9A-Za-z-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])?[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         hidden_phone)]


def plain(t):
    """The text with pseudonyms, and their kinds and values in order."""
    if t is None:
        return None, []
    out, found, done = "", [], 0
    marked = cards(t)
    bounds = [(s, e) for s, e in marked]
    # what stands between cards is searched with a card's place taken by a character that is neither digit nor letter
    veiled = t
    for s, e in bounds:
        veiled = veiled[:s] + "￿" * (e - s) + veiled[e:]
    at = 0
    while at < len(t):
        here = next(((s, e) for s, e in bounds if s == at), None)
        if here:
            v = hidden_card(t[here[0]:here[1]])
            out += v
            found.append(("card", v))
            at = here[1]
            continue
        for kind, pattern, hide in REST:
            m = re.compile(pattern).match(veiled, at)
            if m:
                v = hide(m.group())
                if v is not None:
                    found.append((kind, v))
                out += v if v is not None else m.group()
                at = m.end()
                break
        else:
            out += t[at]
            at += 1
    return out, found


AWKWARD = ["555-123-4567 2025-01-31", "order 1234 5678 4111 1111 1111 1111", "12345678901 555-123-4567",
           "call 555-123-4567 4111 1111 1111 1111", "4111111111111111 12/27", "12 4111111111111111", "a@" + "b." * 2000,
           "mail 4111111111111111@x.com", "4111-1111-1111-1111-555 x", "3782 822463 10005 and 2025-02-30 2025-02-28 10.0.0.1",
           "+1 (988) 555-2485, 988-555-2485; 1.2.3.4.5 1.2.3.4", "Bob.Smith+x@mail.example.org. 29.02.1984 02/29/1984"]


def random_texts(n):
    r = random.Random(8)
    card = "4111111111111111"
    parts = [card, "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "3782 822463 10005", "555-123-4567", "555-1234",
             "(555) 123-4567", "+49 555 123 4567", "2025-01-31", "31.12.1999", "02/30/2001", "1799/01/01", "10.0.0.1", "300.1.1.1",
             "a.b@c.de", "Q_9%x@y-z.co.uk", "12", "7", "1234 5678", "word", "é", "@", ".", "x9"]
    seps = [" ", " ", " ", ", ", "-", "\n", ".", "/", "", "; "]
    return ["".join(r.choice(parts) + r.choice(seps) for _ in range(r.randint(1, 6))) for _ in range(n)]


def test_pseudonyms_equal_plain_version(spark):
    rows = list(enumerate([None, "", "nothing", *AWKWARD, *random_texts(1500)]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wrong = []
    for r in pii.pseudonymised(df, KEY).collect():
        want = plain(rows[r.doc_id][1])
        got = (r.text, [(v.kind, v.value) for v in r.pii])
        if got != want:
            wrong.append((rows[r.doc_id][1], got, want))
    assert not wrong, (len(wrong), wrong[:3])


def test_columns_that_clash(spark):
    df = spark.createDataFrame([("a@b.c", "m", "t", "v", 7)], "text string, __m string, __t string, parts string, PII long")
    r = pii.pseudonymised(df, KEY).first()
    assert r.__fields__ == ["text", "__m", "__t", "parts", "pii"]
    assert (r["__m"], r["__t"], r["parts"]) == ("m", "t", "v") and [v.kind for v in r["pii"]] == ["email"]
    assert "a@b.c" not in str(r)


def test_marks_in_the_text_stay(spark):
    t = f"{pii.MARK}{pii.CARD}4111111111111111 {pii.ESCAPE}﷑ 555-1234 {pii.ESCAPE}"
    r = pii.pseudonymised(spark.createDataFrame([(t,)], "text string"), KEY).first()
    assert [v.kind for v in r.pii] == ["card", "phone"]
    assert re.sub("[0-9]", "0", r.text) == re.sub("[0-9]", "0", t)


@pytest.mark.parametrize("text", ["a@" + "b." * 50_000, "1 " * 50_000, "4111 1111 1111 1111 " * 5_000, "+" * 100_000, "a.b%" * 25_000])
def test_long_texts_end_in_seconds(spark, text):
    begin = time.time()
    df = spark.createDataFrame([(text,)], "text string")
    n, size = pii.pseudonymised(df, KEY).select(F.size("pii"), F.length("text")).first()
    assert size == len(text) and time.time() - begin < 60
    assert n == (1 if "@" in text else 5_000 if text.startswith("4111") else 0)

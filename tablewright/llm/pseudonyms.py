"""Pseudonyms for personal numbers, dates and addresses, by a keyed permutation of each format."""

from __future__ import annotations

import datetime
import hmac
import re
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tablewright.llm.common import slices, take

ROUNDS = 8
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email")

#: What each kind looks like, before it is validated.
PATTERNS = {
    # from the start of a run of name characters, so that each run is read once
    "email": r"(?<![A-Za-z0-9._%+-])[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}(?P<d1>[-/.])[0-9]{1,2}(?P=d1)[0-9]{1,2}|[0-9]{1,2}(?P<d2>[-/.])[0-9]{1,2}(?P=d2)[0-9]{4})(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?P<c1>[ -])[0-9]{4}(?P=c1)[0-9]{4}(?P=c1)[0-9]{4}|[0-9]{4}(?P<c2>[ -])[0-9]{6}(?P=c2)[0-9]{5})(?![0-9A-Za-z])",
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))
_KIND = {k: re.compile(p) for k, p in PATTERNS.items()}
#: Kinds that take in groups of what follows, and what may not stand behind a shorter end.
_OPEN = {"iban": re.compile(r"(?![A-Za-z0-9])"), "phone": re.compile(r"(?![0-9]|[.-][0-9])")}
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "PT LY ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}
#: Digits behind a country code, at most.
PHONE_DIGITS = {
    "1": 10, "7": 10, "20": 10, "27": 9, "30": 10, "31": 10, "32": 10, "33": 10, "34": 9, "36": 9, "39": 11, "41": 10, "44": 10,
    "45": 8, "46": 10, "47": 8, "48": 9, "49": 12, "52": 10, "55": 11, "61": 10, "64": 10, "81": 11, "86": 11, "91": 10,
}
_CODE = re.compile(r"\+([0-9]{1,3})(?=[ .(-])")
_FIXED_PHONE = re.compile(PATTERNS["phone"].split("|(?<!")[0])
_MAY_HOLD = re.compile(r"[0-9@]")
_EPOCH = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _EPOCH


def _noise(key: bytes, message: bytes, modulus: int) -> int:
    """Keyed noise for a half of this modulus: 64 bits wider than it, so that every digit moves, and evenly."""
    width = (modulus.bit_length() + 64 + 7) // 8
    out = hmac.digest(key, message, sha256)
    while len(out) < width:
        out += hmac.digest(key, message + b":%d" % len(out), sha256)
    return int.from_bytes(out[: max(width, 16)], "big")


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed one-to-one map of 0..size-1 onto itself: a Feistel network, walked until inside.

    The network permutes the pairs of halves a*b >= size; a value that lands
    outside is put through again, which keeps the map one-to-one.
    """
    if size <= 1:
        return value
    a = 1 << ((size - 1).bit_length() + 1) // 2
    b = -(-size // a)
    name = f"{tweak}:{size}:".encode()
    while True:
        left, right, m, n = value // b, value % b, a, b
        for r in range(ROUNDS):
            noise = _noise(key, name + b"%d:%d" % (r, right), m)
            left, right, m, n = right, (left + noise) % m, n, m
        value = left * n + right
        if value < size:
            return value


def unpermute(value: int, size: int, key: bytes, tweak: str) -> int:
    """The inverse of ``permute``."""
    if size <= 1:
        return value
    a = 1 << ((size - 1).bit_length() + 1) // 2
    b = -(-size // a)
    name = f"{tweak}:{size}:".encode()
    m, n = (a, b) if ROUNDS % 2 == 0 else (b, a)
    while True:
        left, right, p, q = value // n, value % n, m, n
        for r in reversed(range(ROUNDS)):
            # before round r: right was ``left``, and left had the modulus that right has now
            noise = _noise(key, name + b"%d:%d" % (r, left), q)
            left, right, p, q = (right - noise) % q, left, q, p
        value = left * b + right
        if value < size:
            return value


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _put(text: str, digits: str) -> str:
    """``text`` with its digits replaced one by one."""
    left = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(left), text)


def luhn(digits: str) -> int:
    """The check digit for ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 - i % 2)
        total += x - 9 * (x > 9)
    return -total % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


# Each kind: the pseudonym of a match, or None if the match isn't valid. ``move`` permutes.
Move = Callable[[int, int, str], int]


def _card(text: str, move: Move) -> str | None:
    d = _digits(text)
    if luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    body = str(move(int(d[:-1]), 10 ** (len(d) - 1), "card")).zfill(len(d) - 1)
    return _put(text, body + str(luhn(body)))


def _iban(text: str, move: Move) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body, shape = plain[4:], ["A" if c.isalpha() else "9" for c in plain[4:]]
    value = size = 0
    for c, s in zip(body, shape):
        value = value * (26 if s == "A" else 10) + (ord(c) - 65 if s == "A" else int(c))
    size = 1
    for s in shape:
        size *= 26 if s == "A" else 10
    value, out = move(value, size, "iban"), []
    for s in reversed(shape):
        value, c = divmod(value, 26 if s == "A" else 10)
        out.append(chr(65 + c) if s == "A" else str(c))
    body = "".join(reversed(out))
    check = 98 - _mod97(body + plain[:2] + "00")
    left = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(left) for c in text)


def _ssn(text: str, move: Move) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
        return None
    # areas 1..899 without 666, groups 1..99, serials 1..9999
    place = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    place = move(place, 898 * 99 * 9999, "ssn")
    place, serial = divmod(place, 9999)
    area, group = divmod(place, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text: str, move: Move) -> str | None:
    d = _digits(text)
    if not 7 <= len(d) <= 15:
        return None
    # the country code stays, so that the pseudonym is a number of the same place
    m = _CODE.match(text)
    code = m[1] if m else ""
    rest = d[len(code) :]
    return _put(text, code + str(move(int(rest), 10 ** len(rest), f"phone{code}")).zfill(len(rest)))


def _ip(text: str, move: Move) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    value = move(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(str(x) for x in value.to_bytes(4, "big"))


def _date(text: str, move: Move) -> str | None:
    mark = re.search(r"[-/.]", text)[0]
    parts = text.split(mark)
    first = len(parts[0]) == 4
    year = int(parts[0] if first else parts[2])
    if first:
        month, day, order = int(parts[1]), int(parts[2]), "ymd"
    elif int(parts[1]) > 12:
        month, day, order = int(parts[0]), int(parts[1]), "mdy"
    else:  # day first, as in most of the world
        day, month, order = int(parts[0]), int(parts[1]), "dmy"
    try:
        place = datetime.date(year, month, day).toordinal() - _EPOCH
    except ValueError:
        return None
    if not 0 <= place < _DAYS:
        return None
    out = datetime.date.fromordinal(move(place, _DAYS, "date") + _EPOCH)
    wide = [len(p) for p in parts]
    value = {"y": out.year, "m": out.month, "d": out.day}
    padded = any(len(p) == 2 and p[0] == "0" for p in parts) or min(wide) == 2
    return mark.join(str(value[c]).zfill(4 if c == "y" else 2 if padded else 1) for c in order)


def _email(text: str, move: Move) -> str | None:
    whole, domain = text.split("@")
    local = whole.lstrip("._%+-")  # marks in front aren't part of the name
    shape = [26 if c.isascii() and c.isalpha() else 10 if c.isdigit() else 0 for c in local]
    value, size = 0, 1
    for c, s in zip(local, shape):
        if s:
            value, size = value * s + (ord(c.lower()) - 97 if s == 26 else int(c)), size * s
    marks = "".join("a" if s == 26 else "9" if s else c for c, s in zip(local, shape))
    value, out = move(value, size, f"email{marks}@{domain.lower()}"), []
    for c, s in zip(reversed(local), reversed(shape)):
        if s:
            value, x = divmod(value, s)
            out.append(str(x) if s == 10 else chr((65 if c.isupper() else 97) + x))
        else:
            out.append(c)
    return whole[: len(whole) - len(local)] + "".join(reversed(out)) + "@" + domain


_HANDLERS = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date, "email": _email}


def _whole_phone(text: str, start: int, end: int) -> bool:
    """Whether a number in groups ends at ``end``, by its country and what its groups look like.

    It doesn't if it has more digits than its country allows, or if the
    groups in front of a blank are a number already and what follows is a
    value of another kind, or their last one is a number written in one.
    """
    m = _CODE.match(text, start, end)
    code = m[1] if m else ""
    if code in PHONE_DIGITS and len(_digits(text[start:end])) - len(code) > PHONE_DIGITS[code]:
        return False
    for m in re.finditer(" ", text[start:end]):
        front, at = text[start : start + m.start()], start + m.end()
        n = len(_digits(front))
        if n - len(code) >= 7 and re.search(r"[0-9]{5}$", front):
            return False
        if n >= 7 and any(_value(text, at, k, lambda value, size, tweak: value) for k in _HANDLERS if k != "phone"):
            return False
    return True


def _ends(text: str, start: int, end: int, kind: str) -> Iterator[int]:
    """Where a value may end that may as well end at ``end``: likely ends first, then long ones."""
    if kind not in _OPEN or kind == "phone" and _FIXED_PHONE.fullmatch(text, start, end):
        yield end
        return
    ends = [
        e for e in range(end, start, -1)
        if e == end or _OPEN[kind].match(text, e) and text[e - 1] != " " and _KIND[kind].fullmatch(text, start, e)
    ]
    if kind == "iban":
        length = IBAN_LENGTHS.get(text[start : start + 2])
        likely = [e for e in ends if e - start - text.count(" ", start, e) == length]
    else:
        likely = [e for e in ends if _OPEN[kind].match(text, e) and 7 <= len(_digits(text[start:e])) <= 15 and _whole_phone(text, start, e)]
    yield from likely
    yield from (e for e in ends if e not in likely)


def _value(text: str, start: int, kind: str, move: Move) -> tuple[int, str] | None:
    """End and pseudonym of the valid value of a kind that begins at ``start``, if there is one."""
    if m := _KIND[kind].match(text, start):
        for end in _ends(text, start, m.end(), kind):
            if (new := _HANDLERS[kind](text[start:end], move)) is not None:
                return end, new
    return None


def pseudonymize_text(text: str, key: bytes, counts: dict[str, int] | None = None) -> str:
    """``text`` with every valid value replaced; ``counts`` gets how many of each kind.

    Where something looks like a value, all its ends and then the other kinds
    are tried; if none is valid, the scan goes on behind its first character.
    """
    if not _MAY_HOLD.search(text):
        return text
    move: Move = lambda value, size, tweak: permute(value, size, key, tweak)
    out, done, at = [], 0, 0
    while m := _ANY.search(text, at):
        start, at = m.start(), m.start() + 1
        for kind in PATTERNS:
            if found := _value(text, start, kind, move):
                out += [text[done:start], found[1]]
                done = at = found[0]
                if counts is not None:
                    counts[kind] = counts.get(kind, 0) + 1
                break
    return "".join([*out, text[done:]])


def pseudonym_column(text: Column, key: str) -> Column:
    """struct<text, counts by kind> of a text column; null stays null."""
    secret = key.encode()
    kinds = [f"n_{k}" for k in KINDS]

    @arrow_udf("struct<text: string, " + ", ".join(f"{k}: int" for k in kinds) + ">")
    def replace(column: pa.Array) -> pa.Array:
        texts, found = [], {k: [] for k in KINDS}
        for at, to, _, _ in slices(column):
            for value in column.slice(at, to - at).to_pylist():
                counts: dict[str, int] = {}
                texts.append(None if value is None else pseudonymize_text(value, secret, counts))
                for k in KINDS:
                    found[k].append(counts.get(k, 0))
        arrays = [pa.array(texts, pa.string()), *[pa.array(found[k], pa.int32()) for k in KINDS]]
        return pa.StructArray.from_arrays(arrays, ["text", *kinds])

    return replace(text)


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_replaced and counts by kind of every row.

    Cards (Luhn), IBANs (mod 97), social security numbers, phone numbers, IPv4
    addresses, dates (1900 to 2099) and the local part of e-mail addresses are
    validated and then permuted within their own format under ``key``: same
    length, marks and check digits, and equal values get equal pseudonyms in
    all documents. The map is one-to-one, so different values stay different.
    What fails validation stays, as does all other text; values inside or
    right behind it are found all the same. Null texts stay null,
    empty ones empty; repeated rows are treated each. Long texts, also long runs
    of letters and digits without a blank, take time in proportion to their length.
    """
    rows = take(docs, "doc_id", "text").select("doc_id", pseudonym_column(F.col("text"), key).alias("found"))
    counts = [F.col(f"found.n_{k}") for k in KINDS]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return rows.select(
        "doc_id", F.col("found.text").alias("text"), total.alias("n_replaced"), *[c.alias(f"n_{k}") for k, c in zip(KINDS, counts)]
    )

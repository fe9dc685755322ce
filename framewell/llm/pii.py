"""Personal data replaced by format-preserving pseudonyms.

E-mail addresses (letters of other scripts too), payment card numbers (checked by Luhn, also
grouped 4-6-5), IBANs (checked modulo 97), IPv4 and IPv6 addresses, telephone numbers
(with a plus sign, an area code in brackets, or grouped 3-3-4, also after a 1), social
security numbers and dates in digits (also year first and with two-digit years) are found,
validated, and exchanged for others of the same format.  Not found: ten digits without any
mark, and dates with month names.  The exchange is a keyed permutation of all valid values of
a format: a Feistel network over the bits of the value's number, walked until it falls
on a valid one.  Equal values therefore stay equal across documents, different ones
stay different, no value keeps itself (save where it is the only one of its form), and whoever holds the key can undo it (:func:`pseudonym` with
``back=True``).  Lengths, separators, country codes and mail domains stay; card
numbers keep a right check digit and dates stay dates of 1900 to 2099.

Texts are worked on where they are read; nothing is shuffled.  Defined cases: null
texts stay null and empty ones empty; an empty table gives an empty result; very long
texts are read whole, one at a time; numbers that fail validation are left alone;
repeated rows get equal results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame

from framewell.llm.common import pick

ROUNDS = 8
BATCH_BYTES = 4_000_000
FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days
FIRST_SHORT, SHORT_DAYS = date(2000, 1, 1), (date(2100, 1, 1) - date(2000, 1, 1)).days

EMAIL = re.compile(r"(?<![\w.+%-])[^\W_](?:[\w.%+-]*[^\W_])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])")
IBAN = re.compile(r"(?<![\w+-])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])")
IPV6 = re.compile(r"(?<![\w.:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}(?![\w:])")
NUMBER = re.compile(
    r"(?<![\w.+-])(?:"
    r"(?P<ip>\d{1,3}(?:\.\d{1,3}){3})"
    r"|(?P<date>\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}/\d{1,2}/\d{2}|\d{1,2}\.\d{1,2}\.\d{4})"
    r"|(?P<ssn>\d{3}(?P<gap>[ -])\d{2}(?P=gap)\d{4})"
    r"|(?P<card>\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}(?P<mid>[ -])\d{6}(?P=mid)\d{5})"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){5,11}|(?:1[ .-])?(?:\(\d{3}\) ?\d{3}-\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}))"
    r")(?![\w-]|\.\d)"
)


def permuted(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """The image of ``value`` under a keyed permutation of ``0 .. size-1``, or with ``back`` its origin.

    One step along a cycle of all values in Feistel order, so that none is its own image.
    """
    if size < 2:
        return value
    return feistel((feistel(value, size, key, tweak, True) + (-1 if back else 1)) % size, size, key, tweak)


def feistel(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8

    def turn(r: int, x: int) -> int:
        data = x.to_bytes(width, "big") + bytes([r]) + f"{tweak} {size}".encode()
        out = hashlib.blake2b(data, key=key, digest_size=min(64, max(8, width))).digest()
        while len(out) < width:
            out += hashlib.blake2b(out, key=key).digest()
        return int.from_bytes(out, "big") & mask

    while True:
        left, right = value >> half, value & mask
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ turn(r, left), left
            else:
                left, right = right, left ^ turn(r, right)
        value = (left << half) | right
        if value < size:
            return value


def walked(digits: str, valid: Callable[[str], bool], key: bytes, tweak: str, back: bool) -> str:
    """Permute a string of digits within those that are valid (it is valid itself, so the walk ends)."""
    while True:
        digits = str(permuted(int(digits), 10 ** len(digits), key, tweak, back)).zfill(len(digits))
        if valid(digits):
            return digits


def refill(shape: str, digits: str) -> str:
    """``shape`` with its digits exchanged in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


def check_digit(digits: str) -> str:
    doubled = [int(d) * 2 if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def _run(first: str, last: str, without: str = "") -> str:
    return "".join(c for c in map(chr, range(ord(first), ord(last) + 1)) if c not in without)


ALPHABETS = (
    (_run("a", "z"), "letters"), (_run("A", "Z"), "capitals"), (_run("0", "9"), "digits"),
    (_run("\u00df", "\u00ff", "\u00f7"), "marked letters"), (_run("\u00c0", "\u00de", "\u00d7"), "marked capitals"),
    (_run("\u03b1", "\u03c9"), "greek"), (_run("\u0430", "\u044f"), "cyrillic"), (_run("\u0410", "\u042f"), "cyrillic capitals"),
)


def _email(text: str, key: bytes, back: bool) -> str:
    local, domain = text.rsplit("@", 1)
    for symbols, tweak in ALPHABETS:
        own = [c for c in local if c in symbols]
        number = 0
        for c in own:
            number = number * len(symbols) + symbols.index(c)
        number = permuted(number, len(symbols) ** len(own), key, f"email {tweak} {len(own)}", back) if own else 0
        new = []
        for _ in own:
            number, k = divmod(number, len(symbols))
            new.append(symbols[k])
        rest = iter(reversed(new))
        local = "".join(next(rest) if c in symbols else c for c in local)
    return f"{local}@{domain}"


def _card(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or check_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = walked(digits[:-1], lambda d: len(set(d + check_digit(d))) > 1, key, "card", back)
    return refill(text, body + check_digit(body))


def _ip(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts) or not 1 <= int(parts[0]) <= 223:
        return None
    # the values a part of this many digits can take: (smallest, how many)
    ranges = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(p)] for p in parts]
    ranges[0] = {1: (1, 9), 2: (10, 90), 3: (100, 124)}[len(parts[0])]
    number, size = 0, 1
    for p, (low, n) in zip(parts, ranges, strict=True):
        number, size = number * n + int(p) - low, size * n
    number = permuted(number, size, key, "ip " + " ".join(str(len(p)) for p in parts), back)
    out = []
    for low, n in reversed(ranges):
        number, k = divmod(number, n)
        out.append(str(low + k))
    return ".".join(reversed(out))


def _ipv6(text: str, key: bytes, back: bool) -> str | None:
    """Groups keep their number of digits, with leading zeros where they have some."""
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    capitals = text != text.lower()
    if (capitals and text != text.upper()) or not re.search(r"\d", text):
        return None
    groups = [g for g in text.lower().split(":") if g]
    # the values a group of this form can take: (smallest, how many)
    ranges = [(0, 16) if len(g) == 1 else (0, 16 ** (len(g) - 1)) if g[0] == "0" else (16 ** (len(g) - 1), 15 * 16 ** (len(g) - 1)) for g in groups]
    number, size = 0, 1
    for g, (low, n) in zip(groups, ranges, strict=True):
        number, size = number * n + int(g, 16) - low, size * n
    form = " ".join(f"{len(g)}{'z' if len(g) > 1 and g[0] == '0' else ''}" for g in groups)
    while True:  # until it is told from other text as this one is
        number = permuted(number, size, key, f"ipv6 {capitals} {form}", back)
        rest, made = number, []
        for g, (low, n) in zip(reversed(groups), reversed(ranges), strict=True):
            rest, k = divmod(rest, n)
            made.append(f"{low + k:0{len(g)}x}")
        parts = iter(reversed(made))
        out = re.sub(r"[0-9a-f]+", lambda _: next(parts), text.lower())  # noqa: B023
        if re.search(r"\d", out) and (not capitals or re.search(r"[a-f]", out)):
            return out.upper() if capitals else out


def _iban(text: str, key: bytes, back: bool) -> str | None:
    """Digits of the account part are exchanged and the check digits follow; letters stay."""
    compact = text.replace(" ", "")
    country, account = compact[:2], compact[4:]

    def check(account: str) -> str:
        return f"{98 - int(''.join(str(int(c, 36)) for c in account + country) + '00') % 97:02d}"

    digits = re.sub(r"\D", "", account)
    if not 15 <= len(compact) <= 34 or len(digits) < 6 or compact[2:4] != check(account):
        return None
    shape = re.sub(r"\d", "0", account)
    new = permuted(int(digits), 10 ** len(digits), key, f"iban {country} {re.sub('[A-Z]', 'A', shape)}", back)
    account = refill(account, str(new).zfill(len(digits)))
    signs = iter(country + check(account) + account)
    return "".join(c if c == " " else next(signs) for c in text)


def _phone(text: str, key: bytes, back: bool) -> str | None:
    country = (re.match(r"\+\d{1,3}(?=[ .(-])", text) or re.match(r"\+\d", text) or re.match(r"1[ .-]|", text)).group()
    rest = text[len(country) :]
    digits = re.sub(r"\D", "", rest)
    home = country in ("", "+1") or country[0] == "1"
    american = home and len(digits) == 10
    valid = (lambda d: d[0] > "1" and d[3] > "1") if american else (lambda d: True)
    if not 6 <= len(digits) <= 14 or not valid(digits) or (home and not american):
        return None
    return country + refill(rest, walked(digits, valid, key, f"phone {country}", back))


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    valid = lambda d: d[:3] not in ("000", "666") and d[0] < "9" and d[3:5] != "00" and d[5:] != "0000"
    digits = re.sub(r"\D", "", text)
    return refill(text, walked(digits, valid, key, "ssn", back)) if valid(digits) else None


def _date(text: str, key: bytes, back: bool) -> str | None:
    """The order of day and month is read from the value where only one is possible, else day first (month first with slashes)."""
    parts = [int(p) for p in re.split(r"[-/.]", text)]
    short = len(text) - max(text.rfind(c) for c in "-/.") == 3 and text[4:5] not in ("-", "/")
    begin, days = (FIRST_SHORT, SHORT_DAYS) if short else (FIRST_DAY, DAYS)
    if re.match(r"\d{4}[-/]", text):
        year, month, day = parts
        form = f"{{y:04d}}{text[4]}{{m:02d}}{text[4]}{{d:02d}}"
    else:
        sep = "/" if "/" in text else "."
        first, second, year = parts
        year += 2000 if short else 0
        month, day = (first, second) if sep == "/" else (second, first)
        fields = ["{m", "{d"] if sep == "/" else ["{d", "{m"]
        if month > 12 >= day:
            month, day, fields = day, month, fields[::-1]
        wide = [len(p) for p in re.split(r"[/.]", text)[:2]]
        form = sep.join(f"{f}:0{w}d}}" for f, w in zip(fields, wide, strict=True)) + sep + ("{y:02d}" if short else "{y:04d}")
    try:
        number = (date(year, month, day) - begin).days
    except ValueError:
        return None
    if not 0 <= number < days:
        return None
    while True:  # until the new date has the same form
        number = permuted(number, days, key, f"date {form}", back)
        new = begin + timedelta(days=number)
        out = form.format(y=new.year % 100 if short else new.year, m=new.month, d=new.day)
        if len(out) == len(text) and _reads_as(out, form):
            return out


def _reads_as(text: str, form: str) -> bool:
    """Whether a date is read back in the order of fields it was written in."""
    if form.startswith("{y"):
        return True
    first, second = (int(p) for p in re.split(r"[/.]", text)[:2])
    usual = form[:2] == ("{m" if "/" in form else "{d")
    month, day = (first, second) if form[:2] == "{m" else (second, first)
    return usual or day > 12 >= month


KINDS: dict[str, Callable[[str, bytes, bool], str | None]] = {"card": _card, "date": _date, "email": _email, "iban": _iban, "ip": _ip, "ipv6": _ipv6, "phone": _phone, "ssn": _ssn}


def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of a value, or None if it is not valid; ``back`` undoes it."""
    return KINDS[kind](value, key, back)


def replaced(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and the kind and place (in the original) of what was replaced."""
    found = []
    if "@" in text:
        found += [("email", m.start(), m.end(), _email(m.group(), key, False)) for m in EMAIL.finditer(text)]
    for m in IBAN.finditer(text):
        value = m.group()
        while value and (new := _iban(value, key, False)) is None:  # words in capitals may follow
            value = value.rpartition(" ")[0]
        if value:
            found.append(("iban", m.start(), m.start() + len(value), new))
    if text.count(":") > 1:
        found += [("ipv6", m.start(), m.end(), new) for m in IPV6.finditer(text) if (new := _ipv6(m.group(), key, False)) is not None]
    taken = [(a, b) for _, a, b, _ in found]
    for m in NUMBER.finditer(text):
        if any(a < m.end() and m.start() < b for a, b in taken):
            continue
        kind = next(k for k in ("ip", "date", "ssn", "card", "phone") if m.group(k))
        new = KINDS[kind](m.group(), key, False)
        if new is not None:
            found.append((kind, m.start(), m.end(), new))
    out, at = [], 0
    for _, a, b, new in sorted(found, key=lambda f: f[1]):
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), [(k, a, b) for k, a, b, _ in sorted(found, key=lambda f: f[1])]


def pseudonymise(docs: DataFrame, key: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_found, found`` (kind and place in the original) and the new ``text``."""
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    docs = pick(docs, doc_id=id_col, text=text_col)
    kind = {f.name: f.dataType for f in docs.schema}["doc_id"].simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32())]))
        for batch in batches:
            begin, texts, found, weight = 0, [], [], 0
            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                new, hits = (None, []) if text is None else replaced(text, key)
                texts.append(new)
                found.append([{"kind": k, "from": a, "to": b} for k, a, b in hits])
                weight += len(text or "")
                if weight > BATCH_BYTES or i + 1 == batch.num_rows:
                    arrays = [batch.column("doc_id").slice(begin, i + 1 - begin), pa.array([len(f) for f in found], pa.int64()), pa.array(found, spans), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_found", "found", "text"])
                    begin, texts, found, weight = i + 1, [], [], 0

    made = docs.mapInArrow(run, f"doc_id {kind}, n_found bigint, found array<struct<kind:string,`from`:int,`to`:int>>, text string")
    return made.withColumnRenamed("doc_id", id_col)

"""PII: format-preserving Feistel pseudonyms.

Values that pass their validation (card numbers by issuer and check digit, IBANs by remainder, social security
numbers by their ranges, IPv4 addresses, phone numbers by length, e-mail addresses, calendar dates) are permuted
by a keyed Feistel network over exactly the values of their format. The network is a bijection of 0..n-1; values
that fall outside the valid ones are permuted again until one is valid (cycle walking), which keeps it a bijection.
So equal values stay equal in all documents, whatever separators they are written with, and different ones differ; a
phone number is the same with and without its country code's separator, and a North American one without a code too.
Numbers that fail validation are left alone. Kept are a phone number's country code, an IBAN's country and length, a
card's issuer and length, and an e-mail address's host, which names no person.

Defined results: a null text stays null, an empty one empty; texts of any length are searched whole, in linear
time; a text in which two formats overlap takes the one that starts first, then the order of ``KINDS``; repeated
rows get equal results; other columns pass through untouched, whatever their names."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.llm.memo import Memo, lean

ROUNDS = 10
KINDS = ["email", "iban", "ssn", "date", "ip", "card", "phone"]
EMAIL = r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9-]))"
NUMBERS = r"""(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))
|(?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?P<sep>[./-])[0-9]{1,2}(?P=sep)[0-9]{4})(?![0-9-]|[./][0-9]))
|(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))
|(?P<card>(?<![0-9+])(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9]))
|(?P<phone>(?<![\w+])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9]))"""
BOTH = re.compile(f"{EMAIL}\n|{NUMBERS}", re.VERBOSE)
ONLY_NUMBERS = re.compile(NUMBERS, re.VERBOSE)
DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]")
#: Dates that are permuted among themselves.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Country calling codes of two digits; those that begin with 1 or 7 have one, all others three.
TWO_DIGITS = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


class Feistel:
    """A keyed permutation of 0..n-1 for any n, and of the valid values among them."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def once(self, x: int, n: int, tweak: str) -> int:
        side = isqrt(n - 1) + 1
        while True:
            a, b = divmod(x, side)
            for k in range(ROUNDS):
                f = hashlib.blake2b(f"{tweak}|{n}|{k}|{b}".encode(), key=self.key, digest_size=16).digest()
                a, b = b, (a + int.from_bytes(f, "little")) % side
            x = a * side + b
            if x < n:
                return x

    def permute(self, x: int, n: int, tweak: str, valid: Callable[[int], bool] | None = None) -> int:
        """``x`` must be valid itself, else the walk need not end."""
        if n < 2:
            return x
        x = self.once(x, n, tweak)
        while valid and not valid(x):
            x = self.once(x, n, tweak)
        return x


def luhn(digits: str) -> int:
    """Check digit that goes after ``digits``."""
    return -sum(sum(divmod(int(d) * (2 - k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def issuer(number: str) -> str:
    """The issuer that a card number's first digits and length stand for; empty: none."""
    n, two, four = len(number), int(number[:2]), int(number[:4])
    if number[0] == "4" and n in (13, 16, 19):
        return "4"
    if n == 16 and (51 <= two <= 55 or 2221 <= four <= 2720):
        return "5"
    if n == 15 and two in (34, 37):
        return "3"
    if 14 <= n <= 19 and (two in (36, 38, 39) or 300 <= int(number[:3]) <= 305):
        return "36"
    if 16 <= n <= 19 and (four == 6011 or 644 <= int(number[:3]) <= 659):
        return "6"
    if 16 <= n <= 19 and 3528 <= four <= 3589:
        return "35"
    return "62" if 16 <= n <= 19 and two == 62 else ""


def _fill(layout: str, digits: str) -> str:
    new = iter(digits)
    return DIGIT.sub(lambda _: next(new), layout)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.net = Feistel(key)
        self.known = Memo(lambda item: getattr(self, item[0])(item[1]), 100_000)

    # Each takes the text found and gives its pseudonym, or None if it isn't valid.

    def email(self, found: str) -> str:
        name, _, host = found.rpartition("@")
        return f"{self._mixed(name.lower(), 'email', name)}@{host}"

    def _mixed(self, value: str, tweak: str, layout: str) -> str:
        """Letters stay letters and digits digits; other characters stay. Case follows the layout."""
        sizes = [26 if c in LETTERS else 10 if c in "0123456789" else 1 for c in value]
        # Letters beyond a-z count as a-z ones by their code, so that they don't stay either.
        sizes = [26 if n == 1 and c.isalpha() else n for n, c in zip(sizes, value)]
        x, n = 0, 1
        for c, size in zip(value, sizes):
            if size > 1:
                x, n = x * size + (ord(c) - 48 if size == 10 else (ord(c) - 97) % 26), n * size
        shape = "".join(c if s == 1 else f"{ord(c) // 26:x}" if not c.isascii() else "" for c, s in zip(value, sizes))
        x = self.net.permute(x, n, f"{tweak}|{shape}", None)
        out = []
        for c, size, was in zip(reversed(value), reversed(sizes), reversed(layout)):
            if size > 1:
                x, r = divmod(x, size)
                c = str(r) if size == 10 else LETTERS[r].upper() if was.isupper() else LETTERS[r]
            out.append(c)
        return "".join(reversed(out))

    def card(self, found: str) -> str | None:
        number = NOT_DIGIT.sub("", found)
        kind = issuer(number)
        if not kind or luhn(number[:-1]) != int(number[-1]):
            return None
        n = len(number) - 1
        body = f"{self.net.permute(int(number[:-1]), 10**n, f'card{n}', lambda x: issuer(f'{x:0{n}}0') == kind):0{n}}"
        return _fill(found, f"{body}{luhn(body)}")

    def iban(self, found: str) -> str | None:
        value = found.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(value) <= 34 or number(value[4:] + value[:4]) % 97 != 1:
            return None
        body = self._mixed(value[4:].lower(), f"iban{value[:2]}", value[4:])
        new = iter(f"{value[:2]}{98 - number(f'{body}{value[:2]}00') % 97:02}{body}")
        return "".join(c if c == " " else next(new) for c in found)

    def ssn(self, found: str) -> str | None:
        valid = lambda x: x // 10**6 not in (0, 666) and x // 10**6 < 900 and x // 10**4 % 100 and x % 10**4
        x = int(found.replace("-", ""))
        return _fill(found, f"{self.net.permute(x, 10**9, 'ssn', valid):09}") if valid(x) else None

    def ip(self, found: str) -> str | None:
        parts = [int(p) for p in found.split(".")]
        if max(parts) > 255:
            return None
        x = self.net.permute(int.from_bytes(bytes(parts)), 2**32, "ip")
        return ".".join(map(str, x.to_bytes(4)))

    def phone(self, found: str) -> str | None:
        """The country code stays; the national number is permuted within its length and country, however it is written.
        A number without a code is one of the North American plan; a trunk zero in brackets is no part of the number."""
        shape = found.replace("(0)", "(\0)")
        digits = NOT_DIGIT.sub("", shape)
        code = "" if found[0] != "+" else digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGITS else digits[:3]
        own = digits[len(code) :]
        if not 7 <= len(digits) <= 15 or len(own) < 4:
            return None
        n = len(own)
        # Area and exchange codes of the North American plan begin with 2 to 9; numbers that break this stay among themselves.
        plan = lambda x: n == 10 and (code or "1") == "1" and f"{x:010}"[0] > "1" and f"{x:010}"[3] > "1"
        kind = plan(int(own))
        x = self.net.permute(int(own), 10**n, f"phone{code or 1}|{n}", lambda x: plan(x) == kind)
        return _fill(shape, f"{code}{x:0{n}}").replace("\0", "0")

    def date(self, found: str) -> str | None:
        parts = re.split("[./-]", found)
        orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 1, 0), (2, 0, 1)]
        for order in orders:
            try:
                day = dt.date(*(int(parts[k]) for k in order)).toordinal()
            except ValueError:
                continue
            if FIRST_DAY <= day <= LAST_DAY:
                new = dt.date.fromordinal(FIRST_DAY + self.net.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))
                for k, v in zip(order, (new.year, new.month, new.day)):
                    parts[k] = f"{v:0{len(parts[k])}}"
                return found[4 if len(parts[0]) == 4 else len(re.match("[0-9]+", found)[0])].join(parts)
        return None

    def text(self, text: str, counts: dict[str, int]) -> str:
        def new(m: re.Match) -> str:
            kind = next(k for k in KINDS if m.groupdict().get(k) is not None)
            to = self.known[kind, m[0]]
            if to is None:
                return m[0]
            counts[kind] = counts.get(kind, 0) + 1
            return to

        if "@" in text:
            return BOTH.sub(new, text)
        return ONLY_NUMBERS.sub(new, text) if DIGIT.search(text) else text


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with private values replaced in the text; with ``counts``, n_<kind> of each kind are added.
    One narrow pass, no shuffle."""
    workspace.small_batches(docs.sparkSession)
    place = docs.columns.index(text)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"))
    schema = f"`all` {docs.schema.simpleString()}, {', '.join(f'n_{k} int' for k in KINDS)}"

    def run(batches):
        names = Pseudonyms(key)
        for b in batches:
            all_ = b.column(0)
            texts, found = [], []
            for t in all_.field(place).to_pylist():
                found.append({})
                texts.append(names.text(t, found[-1]) if t else t)
            new = pa.StructArray.from_arrays([pa.array(texts, f.type) if k == place else all_.field(k) for k, f in enumerate(all_.type)], fields=list(all_.type))
            yield pa.RecordBatch.from_arrays([new, *(pa.array([f.get(k, 0) for f in found], pa.int32()) for k in KINDS)], names=["all", *(f"n_{k}" for k in KINDS)])

    done = rows.mapInArrow(lean(run), schema)
    return done.select(*[F.col("all")[c].alias(c) for c in docs.columns], *([f"n_{k}" for k in KINDS] if counts else []))


#: For queries over test data; a deployment passes its own secret.
TEST_KEY = b"sonarloom test key"


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(workspace.table(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY, counts=True)

"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates are found by pattern, validated, and replaced by another valid
value of the same format.  The permutation depends on the key and the kind only,
so equal values have equal pseudonyms in all documents, however they are spaced or
written, and the holder of the key can invert them.

A day has one pseudonym in all notations.  So that each notation is read back as it was
written, the pseudonym keeps what decides the reading (``day_class``): whether the day is
below 10, up to 12 or above, whether the month is May, another before October or a later
one, and whether a year of two digits can mean it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from bisect import bisect_left
from datetime import date
from functools import lru_cache
from hashlib import blake2b
from ipaddress import IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MONTHS = ("January February March April May June July August September October November December").split()
MONTH = "(?:" + "|".join([*MONTHS, *(m[:3] for m in MONTHS)]) + ")"
#: Years that two digits mean.
SHORT_YEARS = range(1969, 2069)

#: What may be personal, in the order in which it is tried at a place.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
            r"|[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\1[0-9]{4}"
            r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2})(?![0-9/-])"
            rf"|(?<![0-9A-Za-z.,/-])(?:[0-9]{{1,2}} {MONTH} [0-9]{{4}}|{MONTH} [0-9]{{1,2}}, [0-9]{{4}})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<![0-9.+-])(?<![0-9] )[0-9]{3} [0-9]{2} [0-9]{4}(?![0-9-]| [0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{6}\2[0-9]{4,5}))(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
             r"|(?<![0-9.+-])\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9])|(?<![0-9.+-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
             r"|(?<![0-9.+-])\+[1-9][0-9]{7,14}(?![0-9])|(?<![0-9.+-])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9-]|\.[0-9])"
             r"|(?<![0-9.+-])\+[0-9]{1,3} \(0\)[0-9]{1,4}(?: [0-9]{2,4}){1,3}(?![0-9])"
             r"|(?<![0-9.+-])1-[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
             r"|(?<![0-9.+-])(?<![0-9] )(?:0[0-9]{2,4} [0-9]{3,4} [0-9]{3,4}|[0-9]{3} [0-9]{3} [0-9]{4})(?![0-9-]| [0-9])",
    "ipv6": r"(?<![0-9A-Za-z:])(?=[0-9a-f:]*:[0-9a-f:]*:)[0-9a-f:]{2,39}(?![0-9A-Za-z:])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
}
FOUND = re.compile("|".join(f"(?P<{kind}>{re.sub(r'\\([12])', lambda m: f'(?P=s{m[1]})', p).replace('([/.])', '(?P<s1>[/.])').replace('([ -])', '(?P<s2>[ -])')})"
                            for kind, p in PATTERNS.items()))
MAY_HOLD = re.compile("[0-9@]|::")
#: Characters of an IBAN by its country.
IBAN_SIZE = {country: size for size, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
#: Country calling codes of one and of two digits; all others have three.
CALLING = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})")


def day_class(day: date) -> tuple[int, int, bool]:
    """What the pseudonym of a day keeps, so that any notation of it reads back."""
    return (0 if day.day < 10 else 1 if day.day <= 12 else 2, 1 if day.month == 5 else 2 if day.month >= 10 else 0,
            day.year in SHORT_YEARS)


@lru_cache(maxsize=1)
def days_by_class() -> dict[tuple, list[int]]:
    out: dict[tuple, list[int]] = {}
    for number in range(FIRST_DAY, LAST_DAY + 1):
        out.setdefault(day_class(date.fromordinal(number)), []).append(number)
    return out


class Feistel:
    """A keyed permutation of ``range(size)`` for any size."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, number: int, value: int) -> int:
        return int.from_bytes(blake2b(f"{tweak} {number} {value}".encode(), key=self.key, digest_size=16).digest(), "big")

    def permuted(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """The halves' sizes cover the range; values beyond it are permuted again."""
        if size < 2:
            return value
        a = 1 << (size.bit_length() + 1) // 2
        b = -(-size // a)
        tweak = f"{tweak} {size}"
        while True:
            left, right = divmod(value, b)
            for k in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
                sign = -1 if back else 1
                if k % 2:
                    left = (left + sign * self._round(tweak, k, right)) % a
                else:
                    right = (right + sign * self._round(tweak, k, left)) % b
            value = left * b + right
            if value < size:
                return value


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{rest}{country}00")
    return f"{98 - int(number) % 97:02d}"


def _spread(digits: str, shape: str) -> str:
    """``digits`` in the places of the digits of ``shape``."""
    each = iter(digits)
    return "".join(next(each) if c in DIGITS else c for c in shape)


class Pseudonyms:
    """Replaces each kind of value; a method gives None for one that is not valid."""

    def __init__(self, key: bytes, back: bool = False):
        self.permutation, self.back = Feistel(key), back

    def _number(self, digits: str, tweak: str) -> str:
        size = 10 ** len(digits)
        return f"{self.permutation.permuted(int(digits), size, tweak, self.back):0{len(digits)}d}"

    def _classes(self, text: str, tweak: str) -> str:
        """Letters and digits permuted together, each within its class."""
        sets = [next((s for s in (DIGITS, LOWER, UPPER) if c in s), "") for c in text]
        size, value = 1, 0
        for c, s in zip(text, sets):
            if s:
                size, value = size * len(s), value * len(s) + s.index(c)
        value = self.permutation.permuted(value, size, tweak, self.back)
        out = []
        for c, s in zip(reversed(text), reversed(sets)):
            if s:
                value, k = divmod(value, len(s))
                c = s[k]
            out.append(c)
        return "".join(reversed(out))

    def card(self, text: str) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        if luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1 or not 13 <= len(digits) <= 19:
            return None
        body = self._number(digits[:-1], "card")
        while len(set(body + str(luhn(body)))) == 1:
            body = self._number(body, "card")
        return _spread(body + str(luhn(body)), text)

    def phone(self, text: str) -> str | None:
        country = re.match(r"\+[0-9]{1,3} \(0\)|\+[0-9]{1,3}(?=[ .(-])|1(?=-)|0(?=[0-9]{2,4} )(?![0-9]{2} [0-9]{3} [0-9]{4}$)", text)
        if not country and text[1:].isdigit():
            country = CALLING.match(text)
        head = country.group() if country else ""
        rest = text[len(head):]
        digits = re.sub("[^0-9]", "", rest)
        if not 7 <= len(digits) <= max(12, 16 - len(head)):
            return None
        return head + _spread(self._number(digits, "phone"), rest)

    def ssn(self, text: str) -> str | None:
        def place(a, g, s):  # areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999
            return ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1

        area, group, serial = map(int, re.split("[- ]", text))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        value = self.permutation.permuted(place(area, group, serial), 898 * 99 * 9999, "ssn", self.back)
        value, serial = divmod(value, 9999)
        area, group = divmod(value, 99)
        area += 1 + (area >= 665)
        return _spread(f"{area:03d}{group + 1:02d}{serial + 1:04d}", text)

    def ip(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        value = self.permutation.permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", self.back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def ipv6(self, text: str) -> str | None:
        try:
            value = IPv6Address(text)
        except ValueError:
            return None
        # only the usual short form can be restored; "a::b" is rather a name in a program
        if str(value) != text or not re.search("[0-9]", text) or not re.search("[0-9a-f]{3}", text):
            return None
        return str(IPv6Address(self.permutation.permuted(int(value), 1 << 128, "ipv6", self.back)))

    def date(self, text: str) -> str | None:
        name = re.search("[A-Za-z]+", text)
        if name:
            numbers = [int(n) for n in re.findall("[0-9]+", text)]
            return self._day(numbers[1], [m[:3] for m in MONTHS].index(name[0][:3]) + 1, numbers[0], text)
        parts = re.split("[-/.]", text)
        numbers = [int(n) for n in parts]
        year_first = len(parts[0]) == 4
        if not year_first and len(parts[2]) == 2:
            numbers[2] += 100 * (numbers[2] < SHORT_YEARS[0] % 100) + 1900
        orders = [(0, 1, 2)] if year_first else [(2, 1, 0), (2, 0, 1)]
        for order in orders:  # day first where both readings are dates
            new = self._day(*(numbers[k] for k in order), text, order)
            if new is not None:
                return new
        return None

    def _day(self, year: int, month: int, day: int, text: str, order: tuple = ()) -> str | None:
        """The pseudonym of a day in the notation of ``text``."""
        try:
            given = date(year, month, day)
        except ValueError:
            return None
        if not FIRST_DAY <= given.toordinal() <= LAST_DAY:
            return None
        kind = day_class(given)
        days = days_by_class()[kind]
        at = self.permutation.permuted(bisect_left(days, given.toordinal()), len(days), f"date {kind}", self.back)
        new = date.fromordinal(days[at])
        if not order:
            month_name = next(re.finditer("[A-Za-z]+", text))[0]
            long = month_name in MONTHS
            parts = [str(new.day), MONTHS[new.month - 1] if long else MONTHS[new.month - 1][:3], str(new.year)]
            if len(re.search("[0-9]+", text)[0]) == 2:
                parts[0] = parts[0].zfill(2)
            return f"{parts[0]} {parts[1]} {parts[2]}" if text[0].isdigit() else f"{parts[1]} {parts[0]}, {parts[2]}"
        mark = re.search("[-/.]", text)[0]
        given_parts = text.split(mark)
        wide = all(len(n) >= 2 for n in given_parts)
        fields = [0, 0, 0]
        for place, value in zip(order, (new.year, new.month, new.day)):
            fields[place] = value
        out = []
        for place, value in enumerate(fields):
            if place == order[0]:
                out.append(str(value) if len(given_parts[place]) == 4 else f"{value % 100:02d}")
            else:
                out.append(f"{value:02d}" if wide else str(value))
        return mark.join(out)

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "").upper()
        country, check, rest = plain[:2], plain[2:4], plain[4:]
        if not 11 <= len(rest) <= 30 or iban_check(country, rest) != check:
            return None
        rest = self._classes(rest, f"iban {country}")
        new = iter(country + iban_check(country, rest) + rest)
        out = "".join(c if c == " " else next(new) for c in text)
        return out.lower() if text[0].islower() else out

    def email(self, text: str) -> str | None:
        name, _, host = text.partition("@")
        return f"{self._classes(name, 'email')}@{host}"

    def _shortened(self, text: str) -> Iterator[str]:
        """What of a match may be an IBAN: its country's length, the whole, and each
        shorter part that ends before a blank."""
        ends = [len(text), *(k for k in range(len(text) - 1, 0, -1) if text[k] == " ")]
        size = IBAN_SIZE.get(text[:2].upper())
        yield from (text[:k] for k in sorted(ends, key=lambda k: k - text.count(" ", 0, k) != size))

    def replaced(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with its values replaced, and where they were."""
        spans = []
        if not MAY_HOLD.search(text):
            return text, spans
        out, done, at = [], 0, 0
        while match := FOUND.search(text, at):
            kind = next(k for k in PATTERNS if match[k] is not None)
            make: Callable[[str], str | None] = getattr(self, kind)
            found = match.group()
            parts = self._shortened(found) if kind == "iban" else [found]
            found, new = next(((part, got) for part in parts if (got := make(part)) is not None), (found, None))
            if new is None:
                at = match.start() + 1
                while at < match.end() and text[at - 1].isalnum() and text[at].isalnum():
                    at += 1
                continue
            out += [text[done:match.start()], new]
            done = at = match.start() + len(found)
            spans.append((match.start(), done, kind))
        return "".join([*out, text[done:]]), spans


def pseudonymize(documents: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``text`` with pseudonyms, ``found`` (how many) and
    ``spans`` (start and end in the given text, and kind: email, iban, date, ssn, card,
    phone, ip, ipv6).  ``back`` inverts with the same key.

    Found are e-mail names; IBANs in capitals or small letters; dates as ``2024-01-05``,
    ``2024/01/05``, ``05/01/2024``, ``5.1.2024``, ``01/05/24`` and with English month names;
    numbers of cards and social security (with dashes or blanks); phone numbers with a
    country code, in groups of 3-3-4, or of a leading 0 and two more groups; IPv4 and IPv6
    (in its usual short form).  Other notations, such as two-digit years with dots, phone
    numbers without a break and names of other languages' months, are not.

    Numbers that fail their check (Luhn, mod 97, calendar, ranges) stay as they are.
    Very long texts are read whole.  A null text stays null with nothing found; empty texts and null ids stay; repeated
    rows repeat; an empty table gives no rows; other columns are not read.
    """
    names = Pseudonyms(key, back)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            got = [(None, []) if t is None else names.replaced(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t for t, _ in got], pa.string()),
                 pa.array([len(s) for _, s in got], pa.int32()),
                 pa.array([[dict(zip(("start", "end", "kind"), x)) for x in s] for _, s in got], spans)],
                ["doc_id", "text", "found", "spans"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, text string, found int, spans array<struct<start: int, end: int, kind: string>>")

"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

A value that is validated as of a kind (card and account numbers by their
check digits, telephone and social-security numbers and IP addresses by
their ranges, dates by the calendar, in figures or with the month's name in four languages) is numbered within the values of its
format, and the number is permuted by a Feistel network over two nearly equal
radices, walking on until it falls inside the format. So the pseudonym is a
valid value of the same format, equal values have equal pseudonyms in all
documents whatever their punctuation, and the holder of the key can go back.
E-mail addresses keep their domain and the shape of their name, letters of any script.

A date's pseudonym has a day and a month below ten, and a day above twelve, where the date has, so that it can be written in whatever way the date is:
one date has one pseudonym in all ways of writing it in figures. Beside a month's name another may stand, of the same language
(that which is listed first, where languages share a name).

Numbers that follow a card or account number (a CVV, a date, a BIC) are no part
of it, nor are those before it: each group of a match is tried as the first and as
the last one. Numbers of the usual length (16 digits of most cards, an account
number's by country) are found first, all others, the longest first, in what is
left. Where groups of a number and others beside it pass as a number by chance,
these are replaced, and the way back can then take other groups than the way there.

Numbers of other countries, from + on, keep their first two digits.

A null text stays null, an empty one empty; a long text is searched as a whole. Text that fails
validation stays as it is. Where kinds overlap the one that is listed first in KINDS has the
text. Rows that repeat get the same pseudonyms. No rows give none; further columns stay, but for
those named like the counts, which these replace.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

#: Stands in until a caller passes a secret of their own, as the query does from the session's setting KEY_SETTING.
KEY = b"replace this key"
KEY_SETTING = "spark.tidebar.pseudonyms.key"
ROUNDS = 10
#: Permutations that a worker remembers.
REMEMBERED = 10_000
#: Dates from here on, for so many days.
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73049


class Permutation:
    """A keyed permutation of range(size); label keeps kinds apart."""

    def __init__(self, key: bytes, label: str, size: int):
        self.size, self.label = size, label.encode()
        self.left = isqrt(size - 1) + 1 if size > 1 else 1
        self.right = -(-size // self.left)
        self.key = hashlib.blake2b(key).digest()

    def _round(self, n: int, value: int, size: int) -> int:
        data = b"%s|%d|%d|%d" % (self.label, self.size, n, value)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big") % size

    def _once(self, value: int, back: bool) -> int:
        a, b = divmod(value, self.right)
        for n in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if n % 2:
                b = (b + sign * self._round(n, a, self.right)) % self.right
            else:
                a = (a + sign * self._round(n, b, self.left)) % self.left
        return a * self.right + b

    def __call__(self, value: int, back: bool = False) -> int:
        value = self._once(value, back)
        while value >= self.size:
            value = self._once(value, back)
        return value


def luhn(digits: str) -> int:
    """The check digit that follows the given digits."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _keep_shape(old: str, digits: str) -> str:
    """old with its digits replaced in turn."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in old)


class Pseudonyms:
    """Pseudonyms under one key; back=True undoes them."""

    def __init__(self, key: bytes = KEY, back: bool = False):
        self.key, self.back = key, back
        self.made: dict[tuple[str, int], Permutation] = {}

    def permuted(self, label: str, value: int, size: int) -> int:
        p = self.made.get((label, size))
        if p is None:
            if len(self.made) >= REMEMBERED:  # shapes and domains of addresses are without end
                self.made.clear()
            p = self.made[label, size] = Permutation(self.key, label, size)
        return p(value, self.back)

    def card(self, text: str) -> str | None:
        d = re.sub(r"\D", "", text)
        if not 13 <= len(d) <= 19 or d[0] == "0" or len(set(d)) == 1 or int(d[-1]) != luhn(d[:-1]):
            return None
        n = len(d) - 2  # the first digit, which tells the network, stays; the last follows from the rest
        body = d[0] + f"{self.permuted(f'card{d[0]}', int(d[1:-1]), 10**n):0{n}d}"
        return _keep_shape(text, body + str(luhn(body)))

    def phone(self, text: str) -> str | None:
        d = re.sub(r"\D", "", text)
        own, d = d[:-10], d[-10:]
        if len(d) < 10 or own not in ("", "1"):
            return None
        if d[0] in "01" or d[3] in "01":  # no such number is given out; one that is written as a number still is personal
            if not {"+", "("} & set(text):
                return None
            while True:  # on within the numbers that are not given out
                d = f"{self.permuted('phone, not given out', int(d), 10**10):010d}"
                if d[0] in "01" or d[3] in "01":
                    return _keep_shape(text, own + d)
        n = self.permuted("phone", ((int(d[:3]) - 200) * 800 + int(d[3:6]) - 200) * 10_000 + int(d[6:]), 800 * 800 * 10_000)
        rest, line = divmod(n, 10_000)
        return _keep_shape(text, f"{own}{rest // 800 + 200}{rest % 800 + 200}{line:04d}")

    def foreign_phone(self, text: str) -> str | None:
        d = re.sub(r"\D", "", text)
        if not 8 <= len(d) <= 15:
            return None
        n = len(d) - 2  # the first digits, which tell the country, stay
        return _keep_shape(text, d[:2] + f"{self.permuted(f'foreign{d[:2]}', int(d[2:]), 10**n):0{n}d}")

    def ssn(self, text: str) -> str | None:
        sep = text[3]
        a, b, c = map(int, text.split(sep))
        if not (0 < a < 900 and a != 666 and b and c):
            return None
        a -= a > 666
        n = self.permuted("ssn", ((a - 1) * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999)
        rest, c = divmod(n, 9999)
        a, b = divmod(rest, 99)
        return f"{a + 1 + (a + 1 > 665):03d}{sep}{b + 1:02d}{sep}{c + 1:04d}"

    def ip(self, text: str) -> str | None:
        try:
            n = int(ipaddress.IPv4Address(text))
        except ValueError:
            return None
        return str(ipaddress.IPv4Address(self.permuted("ip", n, 2**32)))

    def iban(self, text: str) -> str | None:
        s = text.replace(" ", "")
        if not 15 <= len(s) <= 34 or int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 != 1:
            return None
        digits = [c for c in s[4:] if c.isdigit()]
        new = iter(f"{self.permuted(f'iban{s[:2]}', int(''.join(digits)), 10 ** len(digits)):0{len(digits)}d}" if digits else "")
        rest = "".join(next(new) if c.isdigit() else c for c in s[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in rest + s[:2] + "00")) % 97
        it = iter(f"{s[:2]}{check:02d}{rest}")
        return "".join(c if c == " " else next(it) for c in text)

    def day(self, n: int, fits: Callable[[datetime.date], bool] = lambda day: True) -> datetime.date:
        """The pseudonym of a day: on until it is of the day's class and fits."""
        own = _class(datetime.date.fromordinal(FIRST_DAY + n))
        while True:
            n = self.permuted("date", n, DAYS)
            new = datetime.date.fromordinal(FIRST_DAY + n)
            if _class(new) == own and fits(new):
                return new

    def date(self, text: str) -> str | None:
        a, sep, b, _, c = re.match(r"(\d+)([-/.])(\d+)([-/.])(\d+)", text).groups()
        first, second = int(a), int(b)
        order = "ymd" if len(a) == 4 else "mdy" if first <= 12 and (sep == "/" or second > 12) else "dmy"
        parts = dict(zip(order, (a, b, c)))
        n = _day({k: int(v) for k, v in parts.items()})
        if n is None:
            return None
        new = self.day(n)
        plain = {k for k in "dm" if len(parts[k]) == 1}
        padded = {k for k in "dm" if parts[k][0] == "0"}
        # written out of one figure where the old one is; a two-figure field goes with the other one
        short = plain if padded else {"d", "m"} if plain else set()
        fields = {"y": f"{new.year:04d}", "m": str(new.month) if "m" in short else f"{new.month:02d}", "d": str(new.day) if "d" in short else f"{new.day:02d}"}
        return sep.join(fields[k] for k in order)

    def month_date(self, text: str) -> str | None:
        m = _MONTH_DATE.fullmatch(text)
        found, number = m["m1"] or m["m2"], m["d1"] or m["d2"]
        language, month = MONTH_OF[found.lower()]
        n = _day({"y": int(m["y"]), "m": month, "d": int(number)})
        if n is None or len(number) > 1 and number[0] == "0":
            return None
        new = self.day(n, lambda day: MONTH_OF[MONTH_NAMES[language][day.month - 1].lower()][0] == language)
        name = MONTH_NAMES[language][new.month - 1]
        name = name.upper() if found.isupper() and len(found) > 1 else name.lower() if found.islower() else name[0].upper() + name[1:]
        suffix = m["s1"] or m["s2"]
        ending = "" if not suffix else "." if suffix == "." else ("th" if 10 < new.day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th"))
        if m["m1"]:
            return f"{new.day}{ending}{m['g1']}{name}{m['g2']}{new.year:04d}"
        return f"{name}{m['g3']}{new.day}{ending}{m['g4']}{new.year:04d}"

    def ipv6(self, text: str) -> str | None:
        try:
            old = ipaddress.IPv6Address(text)
        except ValueError:
            return None
        low = text.lower()
        whole = low == old.exploded
        if not whole and low != str(old):
            return None  # neither of the two ways of writing it that can be told from the number
        n, like = int(old), _written(old)
        while True:
            n = self.permuted("ipv6", n, 2**128)
            new = ipaddress.IPv6Address(n)
            if _written(new) == like:
                break
        out = new.exploded if whole else str(new)
        return out.upper() if text != low else out

    def email(self, text: str) -> str | None:
        name, _, domain = text.rpartition("@")
        low = [c.lower() if len(c.lower()) == 1 else c for c in name]
        alphabets = [_alphabet(c) for c in low]
        if not any(alphabets):
            return None
        size, value = 1, 0
        for c, letters in zip(low, alphabets):
            if letters:
                size, value = size * len(letters), value * len(letters) + letters.index(c)
        # what stays, and where from each letter comes: its first one stands for its alphabet
        shape = "".join(letters[0] if letters else c for c, letters in zip(low, alphabets))
        value = self.permuted(f"email{shape}@{domain.lower()}", value, size)
        new = []
        for c, letters in zip(reversed(low), reversed(alphabets)):
            if letters:
                value, k = divmod(value, len(letters))
                c = letters[k]
            new.append(c)
        return "".join(n.upper() if o != o.lower() and a else n for o, n, a in zip(name, reversed(new), alphabets)) + "@" + domain


#: Names of months, by language; of a name that several have the first language counts.
MONTH_NAMES: dict[str, list[str]] = {
    "english": "January February March April May June July August September October November December".split(),
    "german": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split(),
    "french": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "spanish": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
    "short": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(),
}
MONTH_OF = {name.lower(): (language, k + 1) for language, names in reversed(MONTH_NAMES.items()) for k, name in enumerate(names)}
_NAME = "|".join(sorted(MONTH_OF, key=lambda n: (-len(n), n)))
_MONTH_DATE = re.compile(
    rf"(?:(?P<d1>[0-9]{{1,2}})(?P<s1>\.|st|nd|rd|th)?(?P<g1> | de )(?P<m1>{_NAME})(?P<g2>,? | de )|(?P<m2>{_NAME})(?P<g3> )(?P<d2>[0-9]{{1,2}})(?P<s2>st|nd|rd|th)?(?P<g4>,? ))(?P<y>[0-9]{{4}})",
    re.I,
)


def _class(day: datetime.date) -> tuple[bool, bool, bool]:
    """What the ways of writing a date can tell of it."""
    return day.day < 10, day.month < 10, day.day > 12


def _written(address: ipaddress.IPv6Address) -> tuple[bool, bool]:
    """Whether an address is written alike in full and in short, and has a letter, which tells the case."""
    return str(address) == address.exploded, any(c in "abcdef" for c in str(address))


@lru_cache(1024)
def _alphabet(c: str) -> str:
    """The letters or figures among which a character of a name is replaced; none: it stays."""
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    if "0" <= c <= "9":
        return "0123456789"
    if c.isascii() or not c.isalpha():
        return ""
    near = (chr(k) for k in range(ord(c) & ~31, (ord(c) & ~31) + 32))
    # those that have one form in either case, or have no case
    letters = "".join(x for x in near if x.isalpha() and x.lower() == x and len(x.upper()) == 1 and x.upper().lower() == x)
    return letters if c in letters else ""


def _day(parts: dict[str, int]) -> int | None:
    try:
        n = datetime.date(parts["y"], parts["m"], parts["d"]).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return n if 0 <= n < DAYS else None


#: Kinds in the order in which they claim text.
KINDS: tuple[tuple[str, re.Pattern], ...] = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}@(?:[^\W_](?:[^\W_]|-){0,62}\.)+[^\W\d_]{2,24}(?![\w-])")),
    ("foreign_phone", re.compile(r"(?<![0-9A-Za-z+])\+(?!1)[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,8}\)?){1,6}(?![0-9]|-[0-9])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")),
    ("date", re.compile(r"(?<![0-9/.-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9/-]|\.[0-9])")),
    ("month_date", re.compile(rf"(?<![\w/.-]){_MONTH_DATE.pattern}(?![\w/-])", re.I)),
    ("ipv6", re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}|:):(?:[0-9A-Fa-f]{0,4}:){1,6}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])")),
    ("card", re.compile(r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![0-9]|[- ][0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?![0-9]|-[0-9])")),
)
_DIGITS = re.compile(r"[0-9]{2}")
_GROUP = re.compile(r"[A-Z0-9]+")
#: Kinds whose numbers may stand in a longer match, with the least length of a number.
LEAST = {"card": 13, "iban": 15}
#: From a later group of digits on, behind one that was tried or replaced.
_CARD_ON = re.compile(r"(?<=[0-9]-)[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")
#: Usual lengths of cards by first digit, and lengths of account numbers by country.
CARD_LENGTHS = {"2": 16, "3": 15, "4": 16, "5": 16}
IBAN_LENGTHS = {
    country: int(n)
    for n, countries in (
        line.split(":")
        for line in (
            "15:NO|16:BE|18:DK FI FK FO GL NL SD|19:MK SI|20:AT BA EE KZ LT LU MN XK|21:CH HR LI LV|22:BG BH CR DE GB GE IE ME RS VA|23:AE GI IL IQ OM SO TL|"
            "24:AD CZ ES MD PK RO SA SE SK TN VG|25:LY PT ST|26:IS TR|27:BI DJ FR GR IT MC MR SM|28:AL AZ BY CY DO GT HU LB NI PL SV|29:BR EG PS QA UA|30:JO KW MU YE|31:MT SC|32:LC|33:RU"
        ).split("|")
    )
    for country in countries.split()
}

#: Kinds that are counted with another.
COUNTED_AS = {"month_date": "date", "ipv6": "ip"}
COUNTED = tuple(k for k, _ in KINDS if k not in COUNTED_AS)
REPLACED = T.StructType([T.StructField("text", T.StringType()), *(T.StructField(f"n_{k}", T.LongType()) for k in COUNTED)])


def _ends(kind: str, found: str, usual: bool) -> list[int]:
    """The lengths of a match to try: of a card or account number the usual one, or all other ends of groups, the longest first."""
    if kind not in LEAST:
        return [len(found)]
    length = CARD_LENGTHS.get(found[0]) if kind == "card" else IBAN_LENGTHS.get(found[:2])
    ends = [(m.end(), m.end() - n) for n, m in enumerate(_GROUP.finditer(found))]  # of each group, with and without separators
    return [e for e, n in reversed(ends) if (n == length) == usual and n >= LEAST[kind]]


def replaced(text: str | None, pseudonyms: Pseudonyms) -> tuple:
    """The text with pseudonyms, and how many values of each kind were replaced."""
    counts = dict.fromkeys(COUNTED, 0)
    if not text:
        return (text, *counts.values())
    found: list[tuple[int, int, str]] = []
    digits = bool(_DIGITS.search(text))
    for kind, pattern in KINDS:
        if not ("@" in text if kind == "email" else ":" in text if kind == "ipv6" else digits):
            continue
        for usual in (True, False) if kind in LEAST else (True,):
            own, at = [], 0
            while m := (kind == "card" and at and _CARD_ON.match(text, at + 1)) or pattern.search(text, at):
                start, at = m.start(), m.end()
                for end in (start + n for n in _ends(kind, m[0], usual)):
                    before = bisect_left(found, (end,))  # the spans found before are sorted and apart
                    if before and found[before - 1][1] > start:
                        continue
                    new = getattr(pseudonyms, kind)(text[start:end])
                    if new is not None:
                        own.append((start, end, new))
                        at = end
                        break
                else:
                    if kind in LEAST:
                        at = _GROUP.match(text, start).end()
            counts[COUNTED_AS.get(kind, kind)] += len(own)
            found = sorted(found + own)
    out, at = [], 0
    for start, end, new in found:
        out += text[at:start], new
        at = end
    return ("".join(out) + text[at:], *counts.values())


def replacer(key: bytes = KEY, back: bool = False) -> Callable:
    @F.pandas_udf(REPLACED)
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pseudonyms = Pseudonyms(key, back)
        for series in batches:
            yield pd.DataFrame([replaced(t, pseudonyms) for t in series], columns=REPLACED.names)

    return replace


def pseudonymise(docs: DataFrame, key: bytes = KEY, text: str = "text") -> DataFrame:
    """docs with pseudonyms in text and the counts n_email … n_phone of replaced values; columns of these names are replaced."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in REPLACED.names and c != text]
    name = fresh(docs, "_made")
    return docs.select(*rest, replacer(key)(F.col(f"`{text}`")).alias(name)).select(*rest, f"{name}.*")

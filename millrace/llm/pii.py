"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

A value that passes its type's check is read as a number in the set of all values of its format, permuted
there by a Feistel network under a secret key, and written back in the same layout, with its check digits made anew.
Equal values so get equal pseudonyms in all documents, different ones different pseudonyms, and the key
holder can turn them back. Candidates that fail the check stay as they are.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
from collections.abc import Callable
from datetime import date, timedelta

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import map_slices, with_text
from millrace.session import shared_root

ROUNDS = 8


class Feistel:
    """Keyed permutations of [0, size), one per tweak; walks the cycle until the value lies in range."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _round(self, tweak: bytes, size: int, number: int, half: int, bits: int) -> int:
        n = (bits + 7) // 8
        seed = b"%s|%s|%d|%d|" % (self.key, tweak, size, number) + half.to_bytes(n, "big")
        return int.from_bytes(hashlib.shake_256(seed).digest(n), "big") >> (8 * n - bits)

    def permute(self, value: int, size: int, tweak: bytes, inverse: bool = False) -> int:
        if size < 2:
            return value
        bits = ((size - 1).bit_length() + 1) // 2
        mask = (1 << bits) - 1
        rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
        while True:
            left, right = value >> bits, value & mask
            for r in rounds:
                if inverse:
                    left, right = right ^ self._round(tweak, size, r, left, bits), left
                else:
                    left, right = right, left ^ self._round(tweak, size, r, right, bits)
            value = left << bits | right
            if value < size:
                return value


#: Characters are permuted within these alphabets; others stay.
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])), "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xDF)]))]
_ALPHABET_OF = {c: alphabet for alphabet in ALPHABETS for c in alphabet}
HEX = "0123456789abcdef"

Swap = Callable[[int, int, bytes], int]


def permute_text(text: str, swap: Swap, tweak: bytes, alphabet_of: dict[str, str] = _ALPHABET_OF) -> str:
    """The text as one number with a digit per character, each in the alphabet of its kind."""
    places = [(i, alphabet_of[c]) for i, c in enumerate(text) if c in alphabet_of]
    value, size = 0, 1
    for i, alphabet in places:
        value, size = value * len(alphabet) + alphabet.index(text[i]), size * len(alphabet)
    shape = "".join(str(ALPHABETS.index(a)) if a in ALPHABETS else "h" for _, a in places)
    value, made = swap(value, size, tweak + shape.encode()), list(text)
    for i, alphabet in reversed(places):
        value, made[i] = value // len(alphabet), alphabet[value % len(alphabet)]
    return "".join(made)


def luhn_sum(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _refill(layout: str, symbols: str, kind: Callable[[str], bool] = str.isdigit) -> str:
    """The layout with its digits (or other places) replaced in order."""
    new = iter(symbols)
    return "".join(next(new) if kind(c) else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(text: str, swap: Swap) -> str | None:
    digits = _digits(text)
    if luhn_sum(digits):
        return None
    body = permute_text(digits[:-1], swap, b"card")
    return _refill(text, body + str(-luhn_sum(body + "0") % 10))


def phone(text: str, swap: Swap) -> str | None:
    digits = _digits(text)
    if not 10 <= len(digits) <= 15:
        return None
    kept = len(digits) - 10  # the country code
    return _refill(text, digits[:kept] + permute_text(digits[kept:], swap, b"phone"))


def ipv4(text: str, swap: Swap) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    return ".".join(map(str, swap(int.from_bytes(bytes(parts), "big"), 1 << 32, b"ipv4").to_bytes(4, "big")))


def ipv6(text: str, swap: Swap) -> str | None:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    if text.upper() != text != text.lower() or not any(c.isdigit() for c in text):
        return None
    symbols = HEX if text == text.lower() else HEX.upper()
    return permute_text(text, swap, b"ipv6", dict.fromkeys(symbols, symbols))  # groups keep their lengths


#: Longer ones are no addresses.
EMAIL_CHARS = 254
#: Longer secrets are permuted in blocks of so many characters, which keeps the work linear.
SECRET_CHARS = 256


def email(text: str, swap: Swap) -> str | None:
    if len(text) > EMAIL_CHARS:
        return None
    name, _, top = text.rpartition(".")  # the top-level domain stays
    return f"{permute_text(name, swap, b'email')}.{top}"


def secret(text: str, swap: Swap) -> str | None:
    head = re.match(r"(?i)\w+\W+", text).group()
    value = text[len(head):]
    alphabet = dict.fromkeys(HEX, HEX) if set(value) <= set(HEX) else _ALPHABET_OF
    blocks = [permute_text(value[at:at + SECRET_CHARS], swap, b"secret" + (b"%d" % at if at else b""), alphabet) for at in range(0, len(value), SECRET_CHARS)]
    return head + "".join(blocks)


def _iban_rest(body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body)) % 97


def iban(text: str, swap: Swap) -> str | None:
    plain = text.replace(" ", "")
    if _iban_rest(plain[4:] + plain[:4]) != 1:
        return None
    body = permute_text(plain[4:], swap, b"iban" + plain[:2].encode())
    return _refill(text, f"{plain[:2]}{98 - _iban_rest(body + plain[:2] + '00'):02d}{body}", lambda c: c != " ")


def _ssn_ok(number: int) -> bool:
    return number // 1_000_000 not in (0, 666) and number < 900_000_000 and number // 10_000 % 100 > 0 and number % 10_000 > 0


def ssn(text: str, swap: Swap) -> str | None:
    number = int(_digits(text))
    if not _ssn_ok(number):
        return None
    number = swap(number, 10**9, b"ssn")
    while not _ssn_ok(number):  # walk on to the next number that is one
        number = swap(number, 10**9, b"ssn")
    return _refill(text, f"{number:09d}")


FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def day(text: str, swap: Swap) -> str | None:
    """Dates as year-month-day, day and month before the year, or month/day/year where the middle can be no month."""
    a, mark, b, c = re.fullmatch(r"(\d+)([./-])(\d+)[./-](\d+)", text).groups()
    iso, month_first = len(a) == 4, mark == "/" and int(b) > 12
    year, month, dom = (a, b, c) if iso else (c, a, b) if month_first else (c, b, a)
    try:
        number = (date(int(year), int(month), int(dom)) - FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= number < DAYS:
        return None
    padded = len(month) == len(dom) == 2

    def fits(d: date) -> bool:
        """Whether the day can be written in the layout of the given one and read from it again."""
        return (padded or (len(str(d.month)), len(str(d.day))) == (len(month), len(dom))) and (d.day > 12 or not month_first)

    new = None
    while new is None or not fits(new):  # walk on within the dates of this layout
        number = swap(number, DAYS, b"date")
        new = FIRST_DAY + timedelta(days=number)
    m, d = f"{new.month:0{len(month)}d}", f"{new.day:0{len(dom)}d}"
    return mark.join([f"{new.year:04d}", m, d] if iso else [m, d, f"{new.year:04d}"] if month_first else [d, m, f"{new.year:04d}"])


#: Types in order of precedence: pattern of candidates, and the function that checks and rewrites one.
TYPES: dict[str, tuple[str, Callable[[str, Swap], str | None]]] = {
    # a start lies at the beginning of a run of name characters and nothing is read twice, so long runs cost no more than their length
    "email": (r"(?<![\w%+-])(?<![\w%+-]\.)[\w%+-]++(?:\.[\w%+-]++)*+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}", email),
    "secret": (r"(?i:\b(?:token|secret|password|api_?key))[^\w\n]{1,5}[0-9A-Za-z_+/-]{16,}", secret),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    "ipv6": (r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])", ipv6),
    # a number of a version is no address
    "ipv4": (r"(?<![\w.])(?<!ersion )(?<!elease )\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", ipv4),
    "date": (r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}(?P<sep>[./])\d{1,2}(?P=sep)\d{4})(?![./-]?\d)", day),
    "phone": (r"(?<![\w+])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}|\+\d{1,3}(?: \d{2,4}){2,4}|0\d{2,4} \d{3,4} \d{3,4})(?! ?\d)", phone),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn),
    "card": (r"(?<!\d)(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}(?P<gap2>[ -])\d{6}(?P=gap2)\d{5})(?!\d)", card),
}
_CANDIDATE = re.compile("|".join(f"(?P<{name}>{pattern})" for name, (pattern, _) in TYPES.items()))
_DIGIT = re.compile("[@0-9]")  # of an IPv6 address too
_NAMES = ("token", "secret", "password", "apikey", "api_key")


def _may_hold(text: str) -> bool:
    """Whether any candidate can stand in the text: all have a digit or an @, or follow a name of a secret."""
    if _DIGIT.search(text):
        return True
    low = text.lower()
    return any(name in low for name in _NAMES)


def pseudonymise(text: str, feistel: Feistel, inverse: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many of each type it got."""
    counts = dict.fromkeys(TYPES, 0)
    if not _may_hold(text):
        return text, counts

    def swap(value: int, size: int, tweak: bytes) -> int:
        return feistel.permute(value, size, tweak, inverse)

    def put(found: re.Match) -> str:
        name = next(n for n in TYPES if found[n] is not None)
        new = TYPES[name][1](found[name], swap)
        if new is None:
            return found[0]
        counts[name] += 1
        return new

    # no candidate goes beyond a line
    return "\n".join([_CANDIDATE.sub(put, line) if _may_hold(line) else line for line in text.split("\n")]), counts


KEY_CONF = "spark.millrace.pii.key"


def session_key(spark: SparkSession) -> bytes:
    """The key set for the session; without one, a key drawn at random that is kept in the shared folder for later runs.

    Pseudonyms can be turned back by whoever holds the key, so no key is part of the code.
    """
    given = spark.conf.get(KEY_CONF, None)
    if given:
        return given.encode()
    path = f"{shared_root(spark)}/millrace/pii-key"
    try:
        return spark.read.text(path).first().value.encode()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(secrets.token_hex(32),)], "value string").coalesce(1).write.mode("ignore").text(path)
    return spark.read.text(path).first().value.encode()


def pseudonymise_documents(documents: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """One row per row: doc_id, n_found, found_<type> for each type, and the text with pseudonyms.

    A null text is read as empty. Every occurrence in the whole text is replaced; a text without findings stays byte for byte.
    The same key and ``inverse`` give the original back. Repeated rows give repeated results, an empty table
    none; other columns are not read. Nothing is shuffled; a task holds one slice of texts.
    """

    def work(batch: pa.RecordBatch) -> dict:
        feistel = Feistel(key)
        made = [pseudonymise(text, feistel, inverse) for text in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n_found": pa.array([sum(c.values()) for _, c in made], pa.int64()),
                **{f"found_{t}": pa.array([c[t] for _, c in made], pa.int64()) for t in TYPES}, "text": pa.array([t for t, _ in made], pa.string())}

    return map_slices(with_text(documents), work, "doc_id long, n_found long, " + ", ".join(f"found_{t} long" for t in TYPES) + ", text string")

"""Personal data replaced by format-preserving pseudonyms.

Numbers and dates that pass their validation are permuted within their format by a keyed Feistel
network: card numbers stay card numbers with a right check digit, account numbers keep country and
length and get right check digits, dates stay dates in the same notation, and so on. Equal values
have equal pseudonyms in all documents, whatever their separators, and only the key's owner can tell
or reverse them. Mail addresses keep their shape and top-level domain, and access secrets keep their
shape and prefix.

Null texts stay null, empty ones empty; nothing else in a text changes. Where findings overlap, the
first one in the text counts. A number that fails its validation stays. Rows may repeat; other
columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import datetime
import re
import warnings
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROUNDS = 8
#: Session setting that holds the key.
KEY_SETTING = "spark.reviewlens.pseudonyms.key"
#: For tests and trials: whoever reads it here can reverse what it made.
TRIAL_KEY = b"trial key, replace in production"
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1


def _round(key: bytes, tweak: str, number: int, half: int, modulus: int) -> int:
    size = (modulus.bit_length() + 7) // 8 + 8
    seed, out = f"{tweak}|{number}|{half}".encode(), b""
    while len(out) < size:
        out += blake2b(seed + bytes([len(out) // 64]), key=key[:64]).digest()
    return int.from_bytes(out[:size], "big") % modulus


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """Keyed permutation of 0 .. size - 1: alternating rounds on two digits, walked until in range."""
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if number % 2:
                left = (left + sign * _round(key, tweak, number, right, a)) % a
            else:
                right = (right + sign * _round(key, tweak, number, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def permute_until(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """The permutation restricted to valid values: walked until it meets one."""
    while True:
        value = permute(value, size, key, tweak)
        if valid(value):
            return value


def _refill(shape: str, symbols: str) -> str:
    """The shape with its letters and digits replaced in order."""
    left = iter(symbols)
    return "".join(next(left) if c.isalnum() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _permute_letters(text: str, key: bytes, tweak: str, classes: tuple[str, ...] = _CLASSES) -> str:
    """Letters to letters and digits to digits, as one number in mixed base; other signs stay."""
    own = [next((k for k in classes if c in k), None) for c in text]
    value, size = 0, 1
    for c, k in zip(text, own):
        if k:
            value, size = value * len(k) + k.index(c), size * len(k)
    shape = "".join(str(classes.index(k)) if k else c for c, k in zip(text, own))
    value = permute(value, size, key, f"{tweak}|{shape}")
    out = []
    for c, k in zip(reversed(text), reversed(own)):
        if k:
            value, at = divmod(value, len(k))
            c = k[at]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _card(found: str, key: bytes) -> str | None:
    digits = _digits(found)
    if not 13 <= len(digits) <= 19 or not luhn(digits) or len(set(digits)) == 1:
        return None
    body = permute(int(digits[:-1]), 10 ** (len(digits) - 1), key, f"card{len(digits)}")
    body = f"{body:0{len(digits) - 1}d}"
    return _refill(found, body + next(c for c in "0123456789" if luhn(body + c)))


def _phone(found: str, key: bytes) -> str | None:
    digits = _digits(found)
    country = re.match(r"\+(\d{1,3})(?=[ .(-])", found)
    lead = country[1] if country else ""
    rest = digits[len(lead) :]
    if found.startswith("+"):
        if not 8 <= len(digits) <= 15 or not rest:
            return None
    elif len(digits) != 10 or digits[0] in "01":
        return None
    # North American numbers keep an area and an exchange that begin with 2 to 9.
    starts = len(rest) == 10 and lead in ("", "1") and rest[0] > "1" and rest[3] > "1"

    def valid(value: int) -> bool:
        new = f"{value:0{len(rest)}d}"
        return not starts or (new[0] > "1" and new[3] > "1")

    value = permute_until(int(rest), 10 ** len(rest), key, f"phone{len(rest)}{starts}", valid)
    return _refill(found, lead + f"{value:0{len(rest)}d}")


def _network(found: str, key: bytes) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in found.split(".")):
        return None
    value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "network")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _social_valid(value: int) -> bool:
    area, group, serial = value // 10**6, value // 10**4 % 100, value % 10**4
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _social(found: str, key: bytes) -> str | None:
    value = int(_digits(found))
    if not _social_valid(value):
        return None
    return _refill(found, f"{permute_until(value, 10**9, key, 'social', _social_valid):09d}")


def _account_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _account(found: str, key: bytes) -> str | None:
    whole = "".join(c for c in found if c.isalnum())
    country, check, body = whole[:2], whole[2:4], whole[4:]
    if not 15 <= len(whole) <= 34 or _account_check(country, body) != int(check):
        return None
    body = _permute_letters(body, key, f"account{country}")
    return _refill(found, f"{country}{_account_check(country, body):02d}{body}")


def _date(found: str, key: bytes) -> str | None:
    one, two, three = (int(p) for p in re.split(r"\D", found))
    if one > 31:
        order = "ymd"
    elif two > 12:
        order = "mdy"
    else:
        order = "dmy"
    parts = dict(zip(order, (one, two, three)))
    try:
        day = datetime.date(parts["y"], parts["m"], parts["d"]).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    if not 0 <= day < _DAYS:
        return None
    new = datetime.date.fromordinal(_FIRST_DAY + permute(day, _DAYS, key, "date"))
    if order == "mdy":  # stays readable as month first only
        while new.day < 13:
            new = datetime.date.fromordinal(_FIRST_DAY + permute(new.toordinal() - _FIRST_DAY, _DAYS, key, "date"))
    values = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    marks = re.findall(r"\D", found)
    return values[order[0]] + marks[0] + values[order[1]] + marks[1] + values[order[2]]


def _mail(found: str, key: bytes) -> str | None:
    local, _, domain = found.rpartition("@")
    labels, top = domain.rpartition(".")[::2]
    return f"{_permute_letters(local, key, 'mail')}@{_permute_letters(labels, key, 'domain')}.{top}"


def _secret(found: str, key: bytes) -> str | None:
    lead = re.match(r"(?i:AKIA|ASIA|gh[pousr]_|sk-|xox[a-z]-|(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?)", found)[0]
    value = found[len(lead) :]
    hexadecimal = re.fullmatch(r"[0-9a-f]+", value) is not None
    classes = ("0123456789abcdef",) if hexadecimal else _CLASSES
    return lead + _permute_letters(value, key, "secret", classes)


#: Kind, what it looks like, and the pseudonym of a valid one (None: not valid).
_MARKED = [
    ("mail", r"(?<![\w.+-])[A-Za-z0-9_](?:[\w.+%-]{0,62}[\w+%-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w@])", _mail),
]
_NUMBERED = [
    ("secret", r"(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_\w{20,}|sk-\w{16,}|xox[a-z]-[\w-]{10,}|(?i:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?[\"']?[\w+/.-]*\d(?:[\w+/.-]*[\w+/])?)", _secret),
    ("account", r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?!\w)", _account),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\w)|(?<![\w+(.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])", _phone),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\w/-])", _date),
    ("network", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _network),
    ("social", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _social),
    ("card", r"(?<!\w)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\w)", _card),
]
#: Every finding of the second pattern holds one of these.
_PREFIXED = re.compile(r"\d|AKIA|ASIA|gh[pousr]_|sk-|xox")


def _compiled(kinds) -> re.Pattern:
    return re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in kinds))


_MARKED_PATTERN, _NUMBERED_PATTERN = _compiled(_MARKED), _compiled(_NUMBERED)
_PSEUDONYM = {name: rule for name, _, rule in _MARKED + _NUMBERED}


@lru_cache(maxsize=1 << 16)
def _replacement(kind: str, found: str, key: bytes) -> str | None:
    return _PSEUDONYM[kind](found, key)


def session_key(spark: SparkSession) -> bytes:
    """The key the session names; without one the trial key, with a warning."""
    named = spark.conf.get(KEY_SETTING, None)
    if not named:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms are made with the public trial key", stacklevel=2)
    return named.encode() if named else TRIAL_KEY


def findings(text: str, key: bytes) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of each valid finding, in text order, without overlaps."""
    found = []
    for pattern, may in ((_MARKED_PATTERN, "@" in text), (_NUMBERED_PATTERN, _PREFIXED.search(text) is not None)):
        match = pattern.search(text) if may else None
        while match:
            new = _replacement(match.lastgroup, match[0], key)
            if new is not None:
                found.append((match.start(), match.end(), match.lastgroup, new))
            # A rejected finding may hide another that begins inside it.
            match = pattern.search(text, match.end() if new is not None else match.start() + 1)
    reached = 0
    for start, end, kind, new in sorted(found):
        if start >= reached:
            reached = end
            yield start, end, kind, new


def pseudonymized(docs: DataFrame, key: bytes, spans: str | None = None) -> DataFrame:
    """The documents with pseudonyms in ``text``; ``key`` is secret and not empty. ``spans`` names a column for what was replaced
    (start and length in the old text, kind)."""
    if not key:
        raise ValueError("pseudonyms need a key")
    names = docs.columns
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("kind", pa.string())]))
    result = T.StructType(list(docs.schema.fields))
    if spans is not None:
        span = T.StructType().add("start", T.IntegerType()).add("length", T.IntegerType()).add("kind", T.StringType())
        result = result.add(spans, T.ArrayType(span))

    def run(stream):
        for batch in stream:
            at = batch.schema.get_field_index("text")
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                texts, marks = [], []
                for value in some.column(at):
                    text, reached, parts, own = value.as_py(), 0, [], []
                    for start, end, name, new in findings(text, key) if text else ():
                        parts += [text[reached:start], new]
                        own.append({"start": start, "length": end - start, "kind": name})
                        reached = end
                    texts.append(text if not parts else "".join(parts) + text[reached:])
                    marks.append(own)
                columns = some.columns
                columns[at] = pa.array(texts, pa.string())
                if spans is not None:
                    columns = [*columns, pa.array(marks, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=names if spans is None else [*names, spans])

    return docs.mapInArrow(run, result)

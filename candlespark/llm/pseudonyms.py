"""Format-preserving pseudonyms for validated numbers, dates and addresses.

A value is read as an integer of the domain of its format, permuted by a keyed
Feistel network over that domain and written back in the format it came in.
Check digits are left out and computed anew. Equal values give equal pseudonyms
in every document, whatever their separators; the key's holder can invert them.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DAY_ZERO, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
# The registered lengths of IBANs.
IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO EG GT HU LB NI PL SV",
        29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
CARD_SHAPES = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 3, 3, 3), (6, 13)}
FEW_GROUPS = 12
LONGEST_CARD = re.compile(r"(?<!\w)[0-9](?:[ -]?[0-9]){12,18}(?!\w)")
KINDS = ["card", "iban", "ssn", "phone", "date", "ipv4", "email", "secret"]


class Feistel:
    """A keyed permutation of range(n) for each label."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _round(self, label: str, n: int, i: int, half: int) -> int:
        said = f"{label}|{n}|{i}|{half}".encode()
        return int.from_bytes(hmac.digest(self.key, said, hashlib.sha256), "big")

    def _once(self, label: str, n: int, x: int, back: bool) -> int:
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * self._round(label, n, i, right)) % a
            else:
                right = (right + sign * self._round(label, n, i, left)) % b
        return left * b + right

    def permute(self, label: str, n: int, x: int, back: bool = False) -> int:
        """The image of x (or, ``back``, what maps to it): steps until it falls inside range(n)."""
        if n < 2:
            return x
        x = self._once(label, n, x, back)
        while x >= n:
            x = self._once(label, n, x, back)
        return x


def luhn_digit(digits: str) -> str:
    """The check digit for the digits before it."""
    doubled = [int(d) * (2 if i % 2 == 0 else 1) for i, d in enumerate(reversed(digits))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def iban_check(country: str, account: str) -> str:
    digits = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(digits) % 97:02d}"


def refilled(template: str, new: str, is_part: Callable[[str], bool] = str.isdigit) -> str:
    """``template`` with its parts replaced in turn by the characters of ``new``."""
    with_new = iter(new)
    return "".join(next(with_new) if is_part(c) else c for c in template)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def card(text: str, f: Feistel, back: bool) -> str | None:
    if not is_card(text):
        return None
    d = _digits(text)
    n = len(d) - 1
    while True:
        body = f"{f.permute('card', 10**n, int(d[:-1]), back):0{n}d}"
        d = body + luhn_digit(body)
        if len(set(d)) > 1:
            return refilled(text, d)


def is_card(text: str) -> bool:
    d = _digits(text)
    return luhn_digit(d[:-1]) == d[-1] and len(set(d)) > 1


def card_tries(run: str, usual: bool) -> list[tuple[int, int]]:
    """Spans of whole digit groups of ``run`` that may be cards, in the order in which they are tried, which no digit changes.

    Spans grouped as cards are go first, then the longest from the left; unless
    ``usual``, every other one follows (of groups of three digits and more, if
    there are over FEW_GROUPS). Longer spans go before shorter ones.
    """
    groups = [m.span() for m in re.finditer("[0-9]+", run)]
    longest = {m.span() for m in LONGEST_CARD.finditer(run)}
    tries = []
    for i, (start, _) in enumerate(groups):
        n, shape = 0, []
        for first, end in groups[i : i + 19]:
            shape.append(end - first)
            n += shape[-1]
            if n > 19:
                break
            rank = 0 if len(shape) == 1 or tuple(shape) in CARD_SHAPES else 1 if (start, end) in longest else 2
            if n >= 13 and (rank < 2 or (not usual and (len(groups) <= FEW_GROUPS or min(shape) >= 3))):
                tries.append((rank, -n, start, end))
    return [(start, end) for _, _, start, end in sorted(tries)]


def cards(run: str, f: Feistel, back: bool, usual: bool, taken: Callable[[int, int], bool]) -> list[tuple[int, int, str]]:
    """(start, end, pseudonym) of a run's cards, none over another or what is ``taken``.

    A pseudonym that would make a card of what was tried in vain before, or the
    other way round, is permuted on: so the run is cut alike when it is inverted.
    """
    tries, used, spans = card_tries(run, usual), bytearray(len(run)), []
    by_start: dict[int, list[tuple[int, int]]] = {}
    for place, (start, end) in enumerate(tries):
        by_start.setdefault(start, []).append((place, end))
        if not any(used[start:end]) and is_card(run[start:end]) and not taken(start, end):
            used[start:end] = b"\1" * (end - start)
            spans.append((place, start, end))
    out = []
    for place, start, end in reversed(spans) if back else spans:
        before = [(s, e) for s in range(max(0, start - 37), end) for p, e in by_start.get(s, ()) if p < place and e > start]
        held = [is_card(run[s:e]) for s, e in before]
        new = run[start:end]
        while True:
            new = card(new, f, back)
            again = run[:start] + new + run[end:] if before else run
            if [is_card(again[s:e]) for s, e in before] == held:
                break
        run = run[:start] + new + run[end:]
        out.append((start, end, new))
    return out


def ssn(text: str, f: Feistel, back: bool) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if not (0 < area < 900 and area != 666 and 0 < group and 0 < serial):
        return None
    # areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999, numbered without gaps
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(f.permute("ssn", 898 * 99 * 9999, x, back), 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def phone(text: str, f: Feistel, back: bool) -> str | None:
    d = _digits(text)
    lead, rest = d[:-10], d[-10:]
    if text[0] == "+" and 8 <= len(d) <= 10:  # a short national number: all digits but the first two
        return refilled(text, d[:2] + f"{f.permute('phone-short', 10 ** (len(d) - 2), int(d[2:]), back):0{len(d) - 2}d}")
    if len(d) < 10 or len(d) > (15 if text == "+" + d else 13):
        return None
    if rest[0] in "01" or rest[3] in "01":  # outside the North American plan: all digits but the lead, until it is outside again
        while True:
            rest = f"{f.permute('phone-any', 10**10, int(rest), back):010d}"
            if (rest[0] not in "01" and rest[3] in "01") if text == d else rest[0] in "01" or rest[3] in "01":
                return refilled(text, lead + rest)
    x = ((int(rest[0]) - 2) * 100 + int(rest[1:3])) * 8_000_000 + (int(rest[3]) - 2) * 1_000_000 + int(rest[4:])
    area, line = divmod(f.permute("phone", 800 * 8_000_000, x, back), 8_000_000)
    return refilled(text, f"{lead}{area + 200:03d}{line + 2_000_000:07d}")


def phone_ends(text: str) -> list[int]:
    """Where a number that begins ``text`` may end: international ones with separators at ends of groups, longest first."""
    return [m.end() for m in re.finditer("[0-9]+", text)][::-1] if text[0] == "+" else [len(text)]


def _dated(year: str, month: str, day: str, f: Feistel, back: bool) -> dt.date | None:
    try:
        x = dt.date(int(year), int(month), int(day)).toordinal() - DAY_ZERO
    except ValueError:
        return None
    return dt.date.fromordinal(f.permute("date", DAYS, x, back) + DAY_ZERO) if 0 <= x < DAYS else None


def date(text: str, f: Feistel, back: bool) -> str | None:
    parts = re.split(r"[-/.]", text)
    year_first = len(parts[0]) == 4
    found = _dated(*(parts if year_first else reversed(parts)), f, back)
    if found is None and not year_first:
        # month first, as day first is no date; what is written must not be one either
        month, day, year = parts
        found = _dated(year, month, day, f, back)
        while found is not None and found.day <= 12:
            found = _dated(str(found.year), str(found.month), str(found.day), f, back)
        return found and refilled(text, f"{found.month:02d}{found.day:02d}{found.year:04d}")
    if found is None:
        return None
    y, m, d = f"{found.year:04d}", f"{found.month:02d}", f"{found.day:02d}"
    return refilled(text, y + m + d if year_first else d + m + y)


def ipv4(text: str, f: Feistel, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = f.permute("ipv4", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"), back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def iban(text: str, f: Feistel, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
        return None
    account = mixed(plain[4:], f"iban{plain[:2]}", f, back)
    return refilled(text, plain[:2] + iban_check(plain[:2], account) + account, str.isalnum)


def iban_ends(text: str) -> list[int]:
    """Where an IBAN that begins ``text`` may end: at its country's length first, then at ends of groups, longest first."""
    ends = [m.end() for m in re.finditer(r"[A-Z0-9]+", text)]
    own = next((e for e in ends if len(text[:e].replace(" ", "")) == IBAN_LENGTHS.get(text[:2])), None)
    return [*([own] if own else []), *(e for e in reversed(ends) if e != own)]


def mixed(text: str, label: str, f: Feistel, back: bool) -> str:
    """Letters and digits permuted within their kinds, as one mixed-radix number; the rest stays."""
    kinds = [(10, "0") if "0" <= c <= "9" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else None for c in text]
    x, n = 0, 1
    for c, kind in zip(text, kinds, strict=True):
        if kind:
            x, n = x * kind[0] + ord(c) - ord(kind[1]), n * kind[0]
    shape = "".join(kind[1] if kind else c for c, kind in zip(text, kinds, strict=True))
    x = f.permute(f"{label}|{shape}", n, x, back)
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if kinds[i]:
            x, place = divmod(x, kinds[i][0])
            out[i] = chr(ord(kinds[i][1]) + place)
    return "".join(out)


def email(text: str, f: Feistel, back: bool) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{mixed(local, 'email', f, back)}@{domain}"


def secret(text: str, f: Feistel, back: bool) -> str | None:
    """A long hexadecimal key: its digits as one base-16 number; needs letters and digits of one case."""
    if text.isdigit() or text.isalpha() or (text.lower() != text and text.upper() != text):
        return None
    new = f"{f.permute(f'secret{len(text)}', 16 ** len(text), int(text, 16), back):0{len(text)}x}"
    return new.upper() if text != text.lower() else new


# What a value looks like, in the order in which patterns are tried. Fixed values.
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}",
    "secret": r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?",
    "card": r"[0-9]+(?:[ -][0-9]+)*",  # a run of digit groups, see card_tries
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[1-9][0-9]{7,14}(?!\w)|\+[1-9][0-9]{0,2}(?:[ .-](?:\([0-9]{1,4}\) ?)?[0-9]{2,8}){1,5}|[2-9][0-9]{9}(?![.,][0-9])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})",
    "ipv4": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}",
}
_BEFORE, _AFTER = {"phone": r"(?<![\w.])", "ipv4": r"(?<![\w.])"}, {"ipv4": r"(?![\w]|\.[0-9])", "date": r"(?![\w]|[./-][0-9])"}
_REWRITE: dict[str, Callable[[str, Feistel, bool], str | None]] = {"email": email, "secret": secret, "iban": iban, "card": card, "ssn": ssn, "phone": phone, "date": date, "ipv4": ipv4}
_NEEDS = re.compile(r"[0-9]|@")
_COMPILED = {kind: re.compile(_BEFORE.get(kind, r"(?<!\w)") + f"({p})" + _AFTER.get(kind, r"(?!\w)")) for kind, p in PATTERNS.items()}


@dataclass
class Pseudonymiser:
    key: bytes
    back: bool = False

    def __post_init__(self) -> None:
        self.feistel = Feistel(self.key)

    def rewrite(self, text: str) -> tuple[str, dict[str, int]]:
        """(text with pseudonyms, how many of each kind).

        Spans are found on the original text, so that no pseudonym is read
        again; of overlapping ones the kind that comes first in PATTERNS has it.
        """
        counts: dict[str, int] = {}
        spans: list[tuple[int, int, str]] = []
        used = bytearray(len(text))  # 1 for each character of a span

        def found(kind: str, start: int, end: int, new: str) -> None:
            spans.append((start, end, new))
            used[start:end] = b"\1" * (end - start)
            counts[kind] = counts.get(kind, 0) + 1

        def taken(start: int, end: int) -> bool:
            return used.find(1, start, end) >= 0

        def card_runs(usual: bool) -> None:
            for m in _COMPILED["card"].finditer(text):
                if m.end() - m.start() >= 13:
                    at = m.start()
                    for start, end, new in cards(m[0], self.feistel, self.back, usual, lambda s, e: taken(at + s, at + e)):
                        found("card", at + start, at + end, new)

        if _NEEDS.search(text):
            for kind, pattern in _COMPILED.items():
                if kind == "email" and "@" not in text:
                    continue
                if kind == "card":
                    card_runs(usual=True)
                    continue
                at = 0
                while m := pattern.search(text, at):
                    at = m.end()
                    for end in iban_ends(m[0]) if kind == "iban" else phone_ends(m[0]) if kind == "phone" else [len(m[0])]:
                        if taken(m.start(), m.start() + end):
                            continue
                        new = _REWRITE[kind](m[0][:end], self.feistel, self.back)
                        if new is not None:
                            at = m.start() + end
                            found(kind, m.start(), at, new)
                            break
                    else:
                        if kind == "iban":
                            at = m.start() + 1
            # groupings that cards seldom have, where nothing else was read
            card_runs(usual=False)
        if not spans:
            return text, counts
        out, at = [], 0
        for start, end, new in sorted(spans):
            out += [text[at:start], new]
            at = end
        return "".join(out) + text[at:], counts


def pseudonymised(key: bytes, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonymiser(key, back)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                done = [(None, {}) if t is None else own.rewrite(t) for t in part.column("text").to_pylist()]
                counts = [pa.array([c.get(kind, 0) for _, c in done], pa.int64()) for kind in KINDS]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([t for t, _ in done], pa.string()), *counts], names=["doc_id", "text", *[f"n_{k}" for k in KINDS]])

    return run


def pseudonyms(docs: DataFrame, key: bytes, *, back: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_found and one count for each of KINDS.

    Values that fail their format's check (Luhn, IBAN, calendar, octets, ...)
    stay as they are. Cards are tried at every digit group, IBANs at their
    country's length. A date with the month first keeps a day over 12, and a
    card that other digits might make part of another stays apart from them: such
    values may get another pseudonym than elsewhere. A null text stays null and an empty one empty, with no
    finds; repeated rows are rewritten alike; a very long text is rewritten in
    time in proportion to its length. An empty table gives no rows. ``back``
    inverts with the same key. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(pseudonymised(key, back), "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))
    return found.withColumn("n_found", sum((F.col(f"n_{k}") for k in KINDS), F.lit(0)).cast("bigint"))

"""Character scans for personal data: strict spans, looser candidates, and what labelers say.

Plain functions over one text. Every scan is linear in the text: runs are consumed whole and
never tried again from their middle. Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

KINDS = ("email", "ip", "card", "phone", "secret", "account")
#: Kinds with strict spans, which always stay.
STRICT = KINDS[:4]

ABSTAIN, NO, YES = 0, 1, 2
LABELERS = ("form", "checksum", "gazetteer", "words_before", "neighbours")
N_VOTES = 3 ** len(LABELERS)
#: Code points before a span in which a labeler looks for words.
BEFORE = 32

FEATURES = (
    "strict", "letters", "separators", "at_least_12", "at_least_20", "at_least_36", "mostly_digits", "word_before",
    "after_mark", "after_space", "closed", "repetitive",
)
N_FEATURES = 2 ** len(FEATURES)

# Words and prefixes the labelers look up.
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv uk de fr es it nl be ch at pt pl se no dk fi ie cz gr "
    "ru ua tr in cn jp kr tw hk sg au nz ca us mx br ar cl za eu example test invalid".split()
)
WORDS_FOR = {
    "email": frozenset("email mail e-mail contact write reach courriel correo mailto".split()),
    "ip": frozenset("ip address host server addr adresse ping from client".split()),
    "card": frozenset("card visa mastercard amex credit debit cc carte tarjeta karte".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon telefono whatsapp".split()),
    "secret": frozenset("token secret password passwd pwd key apikey api_key access_key auth bearer credential".split()),
    "account": frozenset("iban account ssn social konto compte cuenta".split()),
}
WORDS_AGAINST = {
    "email": frozenset(),
    "ip": frozenset("version release section chapter v".split()),
    "card": frozenset("isbn order invoice serial tracking id".split()),
    "phone": frozenset("order invoice page isbn version date total".split()),
    "secret": frozenset("sha commit checksum md5 hash revision digest".split()),
    "account": frozenset("order invoice part model".split()),
}
ACCOUNT_COUNTRIES = frozenset(
    "AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SA SE SI SK SM TR".split()
)

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_BACKWARD = re.compile(r"[A-Za-z0-9._%+-]++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_WRITTEN_AT = re.compile(r"\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?")
_WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?)[A-Za-z0-9-]++)++")
_IP_SIX = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.])")
_PLAIN_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20.-]{1,2}[0-9]{2,4}){2,4}(?![0-9A-Za-z-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/.@-])[A-Za-z0-9_+/-]{16,}+={0,2}+(?![A-Za-z0-9@])")
_ACCOUNT = re.compile(
    r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?|[0-9]{3}-[0-9]{2}-[0-9]{4})(?![A-Za-z0-9-])"
)
_WORD = re.compile(r"[^\W\d_]+(?:[_-][^\W\d_]+)*")
#: All strict forms but e-mail addresses, and most looser ones, have a digit.
_DIGIT = re.compile("[0-9]")


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    strict: bool
    votes: int
    features: int


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 if value > 4 else 2 * value
        total += value
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_address(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An address starts where its run of local characters starts, or where the last one ended."""
    done, at = 0, text.find("@")
    backward = text[::-1] if at >= 0 else ""
    while at >= 0:
        if domain := _DOMAIN.match(text, at + 1):
            # the same run read from its end; nothing before `done` belongs to it
            local = _LOCAL_BACKWARD.match(backward, len(text) - at, len(text) - done)
            if local:
                yield at - len(local.group()), domain.end()
                done = domain.end()
        at = text.find("@", at + 1)


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping spans per kind, in the order of ``STRICT`` and then by start."""
    spans = [("email", s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if _is_address(m.group())]
    for match in _CARD.finditer(text):
        digits = only_digits(match.group())
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            spans.append(("card", *match.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(only_digits(m.group())) <= 15]
    return spans


def _looser(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that may be personal data but are not strict."""
    for match in _WRITTEN_AT.finditer(text) if "[" in text or "(" in text else ():
        head = text[max(0, match.start() - 64) : match.start()]
        local = _LOCAL_BACKWARD.match(head[::-1])
        domain = _WRITTEN_DOMAIN.match(text, match.end())
        if local and domain:
            yield "email", match.start() - len(local.group()), domain.end()
    for match in _IP_SIX.finditer(text) if ":" in text else ():
        yield "ip", *match.span()
    if not _DIGIT.search(text):
        return
    for match in _CARD.finditer(text):
        if 13 <= len(only_digits(match.group())) <= 19:
            yield "card", *match.span()
    for match in _PLAIN_PHONE.finditer(text):
        if 7 <= len(only_digits(match.group())) <= 15:
            yield "phone", *match.span()
    for match in _SECRET.finditer(text):
        found = match.group()
        if re.search("[0-9]", found) and re.search("[A-Za-z]", found) and len(set(found)) >= 8:
            yield "secret", *match.span()
    for match in _ACCOUNT.finditer(text):
        yield "account", *match.span()


def _form(kind: str, found: str) -> int:
    """Votes on how the span is written."""
    if kind == "email":
        return YES if "@" in found else NO
    if kind == "ip":
        return YES if "." in found or "::" in found or found.count(":") == 7 else NO
    if kind == "card":
        groups = re.split(r"[\x20-]", found)
        if len(groups) == 1:
            return ABSTAIN
        return YES if all(len(g) in (4, 5, 6) for g in groups[:-1]) else NO
    if kind == "phone":
        return YES if found[0] in "+(" else NO
    if kind == "secret":
        hexadecimal = re.fullmatch("[0-9a-f]+|[0-9A-F]+", found) is not None
        return YES if hexadecimal and len(found) in (32, 40, 48, 64, 96, 128) else NO if "/" in found else ABSTAIN
    return ABSTAIN


def _checksum(kind: str, found: str) -> int:
    """Votes on what can be computed from the characters alone."""
    if kind == "card":
        return YES if passes_luhn(only_digits(found)) else NO
    if kind == "ip" and "." in found:
        parts = found.split(".")
        return NO if any(len(p) > 1 and p[0] == "0" for p in parts) else YES
    if kind == "phone":
        digits = only_digits(found)
        return YES if 10 <= len(digits) <= 12 and len(set(digits)) > 2 else NO
    if kind == "secret":
        switches = sum(a.isdigit() != b.isdigit() for a, b in zip(found, found[1:], strict=False))
        return YES if 5 * switches >= len(found) else NO
    if kind == "account":
        if "-" in found:
            return NO if found[:3] in ("000", "666") or found[0] == "9" or found[4:6] == "00" else ABSTAIN
        plain = found.replace(" ", "")
        moved = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return YES if int(moved) % 97 == 1 else NO
    return ABSTAIN


def _gazetteer(kind: str, found: str) -> int:
    """Votes from the lists above and from number prefixes that are given out."""
    if kind == "email":
        return YES if re.split(r"[^A-Za-z0-9]+", found)[-1].lower() in TOP_DOMAINS else NO
    if kind == "card":
        digits = only_digits(found)
        two, four = int(digits[:2]), int(digits[:4])
        issued = (
            (digits[0] == "4" and len(digits) in (13, 16, 19))
            or ((51 <= two <= 55 or 2221 <= four <= 2720) and len(digits) == 16)
            or (two in (34, 37) and len(digits) == 15)
            or ((four == 6011 or two == 65) and 16 <= len(digits) <= 19)
            or (two in (30, 36, 38) and len(digits) == 14)
        )
        return YES if issued else NO
    if kind == "account" and found[:1].isalpha():
        return YES if found[:2] in ACCOUNT_COUNTRIES else NO
    if kind == "phone":
        return ABSTAIN if found[0] == "+" else NO if found[0] == "0" and found[1:2] == "0" else ABSTAIN
    return ABSTAIN


def _words_before(kind: str, words: set[str]) -> int:
    if words & WORDS_FOR[kind]:
        return YES
    # numbers and codes without a word that names them
    return NO if words & WORDS_AGAINST[kind] or kind in ("secret", "account") else ABSTAIN


def _neighbours(kind: str, last: str, following: str) -> int:
    """Votes on the characters next to the span: an assignment or quotes speak for a secret, parts
    of a longer path or number against anything."""
    if last in ("/", "\\", "#", "_", "&", "=") and kind != "secret" or following[:1] in ("/", "\\", "_"):
        return NO
    if kind == "secret":
        return YES if last in ('"', "'", "=", ":") else NO
    return ABSTAIN


def _judged(text: str, kind: str, start: int, end: int, strict: bool) -> Candidate:
    found, before = text[start:end], text[max(0, start - BEFORE) : start]
    words = {w.lower() for w in _WORD.findall(before)[-3:]}
    last, following = before[-1:], text[end : end + 1]
    votes = 0
    for vote in (
        _form(kind, found),
        _checksum(kind, found),
        _gazetteer(kind, found),
        _words_before(kind, words),
        _neighbours(kind, last, following),
    ):
        votes = 3 * votes + vote
    length, digits = end - start, sum("0" <= c <= "9" for c in found)
    features = 0
    for bit, holds in enumerate(
        (
            strict,
            any(c.isalpha() for c in found),
            not found.isalnum(),
            length >= 12,
            length >= 20,
            length >= 36,
            2 * digits > length,
            bool(words & WORDS_FOR[kind]),
            last in ('"', "'", "=", ":", "(", "[", "<"),
            last == "" or last.isspace(),
            following == "" or following.isspace() or following in "\"'.,;:!?)]>",
            len(set(found)) <= 3,
        )
    ):
        features |= int(holds) << bit
    return Candidate(KINDS.index(kind), start, end, strict, votes, features)


def candidates(text: str | None) -> list[Candidate]:
    """Strict spans of all kinds, and looser ones that touch no strict span and no earlier looser
    one. A null text has none."""
    if not text:
        return []
    strict = strict_spans(text)
    found = [_judged(text, kind, s, e, True) for kind, s, e in strict]
    taken = sorted((s, e) for _, s, e in strict)
    more, reach = [], 0
    place, covered = 0, 0
    for s, e, kind in sorted((s, e, KINDS.index(kind)) for kind, s, e in _looser(text)):
        while place < len(taken) and taken[place][0] < e:
            covered = max(covered, taken[place][1])
            place += 1
        # spans come by start, so every strict span that starts before `e` has been seen
        if covered <= s and reach <= s:
            more.append(_judged(text, KINDS[kind], s, e, False))
            reach = e
    return found + more

"""Finding personal data in a text, and keyed replacements of the same type and format."""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from dataclasses import dataclass

#: Forms of address, by the gender they state.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "M", "Signor", "господин", "г-н", "κύριος", "κ"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Srta", "Madame", "Mme", "Mlle", "Signora", "госпожа", "г-жа", "κυρία", "κα"],
    "u": ["Dr", "Prof", "Mx", "Dra"],
}
#: Syllables of invented names by script, and endings of given names by gender.
SYLLABLES = {
    "LATIN": "ba be bo da de di do fa fe ga go ha he ja jo ka ke ko la le li lo lu ma me mi mo na ne no pa pe ra re ri ro sa se so ta te ti to va ve vo".split(),
    "CYRILLIC": "ба бе бо ва ве го да де до ка ке ко ла ле ли ло ма ме ми мо на не но па по ра ре ри ро са се со та те то".split(),
    "GREEK": "βα βε γα γο δα δε δο κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε πο ρα ρε ρι ρο σα σε τα τε το".split(),
}
ENDINGS = {
    "LATIN": {"m": "n", "f": "na", "u": "l"},
    "CYRILLIC": {"m": "н", "f": "на", "u": "ль"},
    "GREEK": {"m": "νος", "f": "να", "u": "λη"},
}

_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
#: Titles after which two family names follow, and words inside family names.
_TWO_SURNAMES = {"Señor", "Señora", "Sr", "Sra", "Srta", "Dra"}
_PARTICLES = "von van vom zu zur zum de der den del della di da du do dos das la le ten ter bin al af av".split()
_NAME = r"[^\W\d_a-z](?:[^\W\d_]+|(?=['’]))(?:[-'’][^\W\d_]+)*"
_TITLE = "|".join(sorted(map(re.escape, _TITLE_GENDER), key=len, reverse=True))
_TITLED = rf"(?:{_TITLE})\.? "
# A name, perhaps behind particles, or an initial; three names at most.
_PIECE = rf"(?:(?:{'|'.join(_PARTICLES)}) ){{0,3}}{_NAME}"
_PERSON = re.compile(rf"(?<!\w)((?:{_TITLED})+)((?:[^\W\d_a-z]\. )*{_PIECE}(?:(?: [^\W\d_a-z]\.)* {_PIECE}){{0,2}})")
_WORD = re.compile(_NAME)
_POSSESSIVE = re.compile("['’][sS]$")
_PART = re.compile(r"\w+")
_EMAIL = re.compile(r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[^\W_](?:(?:[^\W_]|-){0,62})\.)+[^\W\d_]{2,24}(?![\w-])")
_IP = re.compile(r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d)")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.])")
_CARD = re.compile(r"(?<![\d+.-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{1,4}[ /-]\d{5,8}|0\d(?:[ .]\d{2}){4})(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_CLOUD = re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?<!\w)gh[posu]_[A-Za-z0-9]{36}(?!\w)|(?<!\w)sk-[A-Za-z0-9-]{20,}(?!\w)")
_SECRET = re.compile(r"(?<![^\W_])(?:passw(?:or)?d|passphrase|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{6,})", re.I)
_BEARER = re.compile(r"(?<!\w)(?:[Bb]earer\s+([A-Za-z0-9_.~+/=-]{16,})|(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{5,}))")
_SPOKEN = re.compile(r"(?<![^\W_])(?:password|passphrase|token|secret) is [\"']?((?=[^\s\"',;]*[\d!@#$%^&*])[^\s\"',;]{6,}[^\s\"',;.])", re.I)
_DIGIT = re.compile("[0-9]")
_SECRET_MARKS = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "ghu_", "sk-", "=", ":")


@dataclass(frozen=True)
class Entity:
    """A place in a text: the entity's kind, what identifies it, and its letters as written."""

    start: int
    end: int
    kind: str
    value: str


def luhn(digits: str) -> int:
    """The check digit for these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def script_of(name: str) -> str:
    found = unicodedata.name(name[0], "LATIN").split()[0]
    return found if found in SYLLABLES else "LATIN"


def _plain_finds(text: str) -> list:
    """(detector, span group, kind, value) tried from the most to the least certain."""
    tries = []
    if "@" in text:
        tries.append((_EMAIL, 0, lambda m: ("email", m.group().lower())))
    if any(m in text for m in _SECRET_MARKS):
        tries.append((_CLOUD, 0, lambda m: ("key", m.group())))
        tries.append((_SECRET, 1, lambda m: ("secret", m.group(1))))
    if "earer" in text or "eyJ" in text:
        tries += [(_BEARER, 1, lambda m: ("secret", m.group(1))), (_BEARER, 2, lambda m: ("secret", m.group(2)))]
    if any(w + " is " in text for w in ("ssword", "sphrase", "oken", "ecret")):
        tries.append((_SPOKEN, 1, lambda m: ("secret", m.group(1))))
    if "::" in text or text.count(":") > 6:
        tries.append((_IP6, 0, _ip6))
    if _DIGIT.search(text):
        tries += [(_IP, 0, lambda m: ("ip", m.group())), (_IBAN, 0, _iban), (_CARD, 0, _card)]
        tries += [(_SSN, 0, lambda m: ("ssn", _digits(m.group()))), (_PHONE, 0, _phone)]
    return tries


def _ip6(m: re.Match) -> tuple[str, str] | None:
    try:
        address = ipaddress.IPv6Address(m.group())
    except ValueError:
        return None
    # Two letters around colons, as in code, are no address.
    return ("ip6", f"{int(address):032x}") if len(m.group().replace(":", "")) >= 5 else None


def _iban(m: re.Match) -> tuple[str, str] | None:
    v = m.group().replace(" ", "")
    return ("iban", v) if 15 <= len(v) <= 34 and _mod97(v) == 1 else None


def _card(m: re.Match) -> tuple[str, str] | None:
    v = _digits(m.group())
    return ("card", v) if 13 <= len(v) <= 19 and luhn(v[:-1]) == int(v[-1]) else None


def _phone(m: re.Match) -> tuple[str, str] | None:
    v = _digits(m.group())
    return ("phone", ("+" if m.group()[0] == "+" else "") + v) if 7 <= len(v) <= 15 else None


def _persons(text: str) -> list[Entity]:
    """Names after forms of address; initials, particles and a possessive ending aren't part of one.

    One name is a surname.  Of several the first is a given name and the last a surname; what is between them
    is a given name, or a surname after a particle or a title that goes with two family names.
    """
    found = []
    for m in _PERSON.finditer(text):
        titles = [t.rstrip(".") for t in m.group(1).split()]
        gender = next((g for t in titles if (g := _TITLE_GENDER[t]) != "u"), "u")
        names = []
        for w in _WORD.finditer(text, m.start(2), m.end(2)):
            before = text[m.start(2) : w.start()].split()
            names.append((w, bool(before) and before[-1] in _PARTICLES))
        two = any(t in _TWO_SURNAMES for t in titles)
        last = False
        for k, (w, behind) in enumerate(names):
            last = last or behind or k == len(names) - 1 or two and k > 0
            name = _POSSESSIVE.sub("", w.group())
            if len(name) > 1:
                found.append(Entity(w.start(), w.start() + len(name), "surname" if last else f"given_{gender}", name))
    return found


def _mentions(text: str, persons: list[Entity]) -> list[Entity]:
    """Whole words that are names of ``persons``, also in capitals; a name of two persons is the first one's."""
    known: dict[str, Entity] = {}
    for e in persons:
        if e.value not in _TITLE_GENDER and not e.value[0].islower():
            for form in (e.value, e.value.upper(), e.value.title()):
                known.setdefault(form, e)
    found, parts, done = [], list(_PART.finditer(text)) if known else [], 0
    for m, after in zip(parts, [*parts[1:], None]):
        if m.start() < done:
            continue
        ends = [after.end()] if after and after.start() == m.end() + 1 and text[m.end()] in "-'’" else []
        for end in (*ends, m.end()):
            if e := known.get(text[m.start() : end]):
                found.append(Entity(m.start(), end, e.kind, e.value))
                done = end
                break
    return found


def detect(text: str) -> list[Entity]:
    """Entities without overlap, in order.  Cheap tests come first: most texts hold none.

    What a detector has found is blank for the next ones.
    """
    found: list[Entity] = []
    rest = text

    def take(spans: list[Entity]) -> None:
        nonlocal rest
        if spans:
            found.extend(spans)
            parts, at = [], 0
            for e in sorted(spans, key=lambda e: e.start):
                parts += [rest[at : e.start], "\x00" * (e.end - e.start)]
                at = e.end
            rest = "".join([*parts, rest[at:]])

    for pattern, group, read in _plain_finds(text):
        take([Entity(m.start(group), m.end(group), *x) for m in pattern.finditer(rest) if m.group(group) and (x := read(m))])
    if any(t + " " in text or t + ". " in text for t in _TITLE_GENDER):
        persons = _persons(rest)
        take(persons)
        take(_mentions(rest, persons))
    return sorted(found, key=lambda e: e.start)


def _alphabet(c: str, hexadecimal: bool) -> str:
    if hexadecimal and c in "0123456789abcdef":
        return "0123456789abcdef"
    if c.isdigit() and c.isascii():
        return "0123456789"
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"
    if "A" <= c <= "Z":
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return c


class Surrogates:
    """Keyed replacements.  For one kind, format and attempt the map is a bijection on all
    values of that format, so different values never get the same replacement."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _number(self, tweak: str, step: int, value: int, below: int) -> int:
        message = f"{tweak}\x00{step}\x00{value}".encode()
        digest = hashlib.blake2b(message, key=self.key[:64], digest_size=64).digest()
        return int.from_bytes(digest, "big") % below

    def permute(self, text: str, tweak: str, hexadecimal: bool = False) -> str:
        """Each letter stays in its class; an alternating Feistel network over both halves of the text."""
        classes = [_alphabet(c, hexadecimal) for c in text]
        free = [i for i, a in enumerate(classes) if len(a) > 1]
        halves = free[::2], free[1::2]
        tweak = f"{tweak}\x00{''.join(a[0] if len(a) > 1 else a for a in classes)}"

        def read(at: list[int]) -> tuple[int, int]:
            value, size = 0, 1
            for i in at:
                value, size = value * len(classes[i]) + classes[i].index(text[i]), size * len(classes[i])
            return value, size

        (a, size_a), (b, size_b) = read(halves[0]), read(halves[1])
        for step in range(0, 10, 2):
            a = (a + self._number(tweak, step, b, size_a)) % size_a
            b = (b + self._number(tweak, step + 1, a, size_b)) % size_b
        out = list(text)
        for at, value in ((halves[0], a), (halves[1], b)):
            for i in reversed(at):
                value, k = divmod(value, len(classes[i]))
                out[i] = classes[i][k]
        return "".join(out)

    def _invented(self, kind: str, value: str, attempt: int) -> str:
        """A name of the value's script; given names end as their gender asks for."""
        script = script_of(value)
        syllables, gender = SYLLABLES[script], kind.partition("_")[2]
        n = 3 + attempt // 4
        at = self._number(f"{kind}\x00{attempt}", n, int.from_bytes(value.casefold().encode(), "big"), len(syllables) ** n)
        name = ""
        for _ in range(n):
            at, k = divmod(at, len(syllables))
            name += syllables[k]
        return name.capitalize() + (ENDINGS[script][gender] if gender else "")

    def replacement(self, kind: str, value: str, attempt: int = 0) -> str:
        """For the value that identifies an entity."""
        tweak = f"{kind}\x00{attempt}"
        if kind == "email":
            local, _, domain = value.partition("@")
            host, _, suffix = domain.rpartition(".")
            return f"{self.permute(f'{local}@{host}', tweak)}.{suffix}"
        if kind == "ip":
            number = 0
            for part in value.split("."):
                number = number << 8 | int(part)
            hexed = int(self.permute(f"{number:08x}", tweak, hexadecimal=True), 16)
            return ".".join(str(hexed >> s & 255) for s in (24, 16, 8, 0))
        if kind == "ip6":
            return ipaddress.IPv6Address(int(self.permute(value, tweak, hexadecimal=True), 16)).compressed
        if kind == "card":
            body = value[0] + self.permute(value[1:-1], tweak)
            # What was a valid number stays one; an invalid one stays as wrong as it was.
            return body + str((luhn(body) + int(value[-1]) - luhn(value[:-1])) % 10)
        if kind == "iban":
            body = value[:2] + "00" + self.permute(value[4:], tweak)
            return f"{value[:2]}{98 - _mod97(body):02d}{body[4:]}"
        if kind == "phone":
            plus = value[:2] if value[0] == "+" else ""
            return plus + self.permute(value[len(plus) :], tweak)
        if kind == "ssn":
            return self.permute(value, tweak)
        if kind == "key":
            mark = re.match(r"AKIA|ASIA|gh[posu]_|sk-", value).group()
            return mark + self.permute(value[len(mark) :], tweak)
        if kind == "secret":
            return self.permute(value, tweak, hexadecimal=all(c in "0123456789abcdef" for c in value))
        return self._invented(kind, value, attempt)


def written_like(written: str, replacement: str, kind: str) -> str:
    """The replacement with the separators and capitals of the place it goes to."""
    if kind in ("phone", "card", "ssn", "iban"):
        chars = iter(replacement.lstrip("+"))
        return "".join(next(chars) if c.isalnum() else c for c in written)
    if kind == "email":
        return "".join(r.upper() if w.isupper() else r for w, r in zip(written, replacement))
    if (kind == "surname" or kind.startswith("given")) and written.isupper():
        return replacement.upper()
    return replacement

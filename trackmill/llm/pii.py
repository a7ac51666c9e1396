"""Personal data replaced by surrogates of the same type, gender, script and format.

Numbers and addresses go through a keyed permutation of all strings of their form, so
distinct entities always get distinct surrogates and an entity has the same one everywhere.
Surnames are numbered, whatever their letters, and a keyed permutation of the numbers is
written in syllables, so no two ever meet. A surrogate that is a surname of the corpus gets
a next variant, by itself. Given names of the fixed lists are permuted within their list; others
are written in syllables too, with an ending by gender, so that no two given names meet.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.work import Scratch, map_batches

# Titles by gender, in the languages covered.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Doña", "госпожа"),
    "n": ("Dr", "Prof", "Professor", "Doctor", "Docteur", "Doktor", "Mx"),
}
# Given names by gender and script.
GIVEN = {
    ("m", "latin"): ("Adrian", "Bruno", "Conrad", "Daniel", "Emil", "Felix", "Gregor", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noel", "Oscar", "Paul", "Peter", "Thomas", "Michael", "David", "James", "John", "Robert", "William", "Richard", "Joseph", "George", "Charles", "Henry", "Edward", "Stephen", "Kevin", "Hans", "Klaus", "Stefan", "Andreas", "Pierre", "Jean", "Louis", "Carlos", "José", "Juan", "Luis", "Pedro"),
    ("f", "latin"): ("Alma", "Bianca", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irma", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula", "Anna", "Emma", "Sarah", "Mary", "Elizabeth", "Jennifer", "Linda", "Barbara", "Susan", "Jessica", "Karen", "Nancy", "Margaret", "Emily", "Alice", "Jane", "Katharina", "Sabine", "Ursula", "Claire", "Sophie", "Camille", "Isabel", "Carmen", "Ana", "Lucía", "Marie", "Amy"),
    ("n", "latin"): ("Alex", "Andrea", "Charlie", "Dominique", "Eden", "Florence", "Gael", "Jordan", "Kim", "Luca", "Morgan", "Noa", "Quinn", "Robin", "Sascha", "Toni"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Леонид", "Максим", "Олег", "Павел", "Роман", "Сергей", "Тимур", "Юрий"),
    ("f", "cyrillic"): ("Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Ксения", "Лариса", "Марина", "Нина", "Ольга", "Полина", "Раиса", "Софья"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Слава"),
}
# Consonants and vowels that made-up surnames alternate, by script.
SOUNDS = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрстф", "аеиоу")}
# Letters that stand for one another, by class.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýß",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω",
)
# Endings of made-up given names by gender, by script; none can end syllables of even length.
# Then the signs by which names are numbered, and further letters that take two signs, by script.
ENDINGS = {"latin": {"m": "s", "f": "a", "n": ""}, "cyrillic": {"m": "н", "f": "а", "n": ""}}
SIGNS = {"latin": ALPHABETS[1] + "'-", "cyrillic": ALPHABETS[5] + "'-"}
FURTHER = {"latin": ALPHABETS[3], "cyrillic": "ёіїєґўјљњћђџ"}
_CLASS = {letter: letters for letters in ALPHABETS for letter in letters}

# Large letters of the extended Latin and Cyrillic blocks stand one by one between the small ones.
_UPPER = "A-ZÀ-ÖØ-ÞА-Я" + "".join(c for c in map(chr, (*range(0x100, 0x250), *range(0x400, 0x410), *range(0x460, 0x530))) if c.isupper())
LOCAL = re.compile(r"[\w.+%-]{0,63}[\w+%-]$")  # 64 characters at most, as addresses allow
EMAIL = re.compile(r"([\w.+%-]{0,63}[\w+%-])@(?:[\w-]+\.)+[\w-]*\w")
IP6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{3,39}(?<!\w:)(?![\w:]|\.\d)")
IP4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,3}|\(\d{2,5}\) ?\d{2,4}(?:[ .\-]?\d{2,4}){1,2}|\d{3}[ .\-]\d{3}[ .\-]\d{4}|0\d{1,4}[ /\-]\d{5,9}|0\d{1,4}(?:[ ./\-]\d{2,4}){2,4})(?!\w)")
SOCIAL = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
ACCOUNT = re.compile(r"(?<![\w.\-])(?:\d{4}(?:[ \-]?\d{4}){2}(?:[ \-]?\d{1,7})?|\d{4}([ \-])\d{6}\1\d{4,5})(?![\w]|[.\-]\d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_ALL_TITLES = sorted((t for group in TITLES.values() for t in group), key=len, reverse=True)
# Initials may come before and between names.
_NAME = rf"[{_UPPER}][\w'’\-]+"
_INITIALS = rf"(?:[{_UPPER}]\. ?)*"
PERSON = re.compile(rf"(?<!\w)({'|'.join(_ALL_TITLES)})(\.? {_INITIALS})({_NAME})(?:( {_INITIALS})({_NAME}))?")
WORD = re.compile(rf"(?<![\w'’\-])({_NAME})")
UNTITLED = re.compile(rf"(?<![\w'’\-])({_NAME})(?=( {_INITIALS})({_NAME}))")
# Words that are no names where they follow or stand alone, though written large.
NO_NAMES = frozenset(
    "a an and are as at but by can could did do does for from had has have he her here his how i if in is it its my no not of on or our she so that the their "
    "then there these they this those to was we were what when where which who why will with would you your der die das und ist ein eine le la les et est el los y".split()
)
_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_DIGIT = re.compile(r"\d")


@dataclass(frozen=True)
class Settings:
    """The secret key, and how many variants of a surname's surrogate are tried where they are
    surnames of the corpus themselves (None: until none is)."""

    key: bytes = b"change-this-key-for-every-release"
    tries: int | None = None


@dataclass(frozen=True)
class Names:
    """The key for names, the variants of those surnames of a text whose surrogate is not their first, and
    the genders of its given names that come with a title of no gender and elsewhere with one.
    `by_text` is the table that the variants and genders of a text are taken from."""

    key: bytes
    variants: dict[str, int] = field(default_factory=dict)
    genders: dict[str, str] = field(default_factory=dict)
    by_text: DataFrame | None = field(default=None, compare=False, repr=False)


def _digest(key: bytes, *parts: object) -> int:
    text = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hmac.digest(key, text, hashlib.sha256)[:16], "big")


def permuted(key: bytes, kind: str, value: int, size: int) -> int:
    """A keyed permutation of range(size): a Feistel network over the next even number of bits,
    walked until it lands inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for step in range(6):
            left, right = right, left ^ (_digest(key, kind, size, step, right) & mask)
        value = (left << half) | right
        if value < size:
            return value


def same_form(key: bytes, kind: str, text: str) -> str:
    """Another text with letters and digits of the same classes at the same places; a bijection."""
    form = "".join(_CLASS[c][0] if c in _CLASS else c for c in text)
    value, size = 0, 1
    for c in text:
        if c in _CLASS:
            letters = _CLASS[c]
            value, size = value * len(letters) + letters.index(c), size * len(letters)
    if size == 1:
        return text
    value = permuted(key, f"{kind}:{form}", value, size)
    made = []
    for c in reversed(text):
        letters = _CLASS.get(c)
        if letters:
            value, digit = divmod(value, len(letters))
            made.append(letters[digit])
        else:
            made.append(c)
    return "".join(reversed(made))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _refill(pattern: str, digits: str) -> str:
    """The digits in the places of the pattern's digits or letters."""
    left = iter(digits)
    return "".join(next(left) if c.isalnum() else c for c in pattern)


def _walk(key: bytes, kind: str, text: str, good: Callable[[str], bool]) -> str:
    """The permutation restricted to texts that are good, as this one is."""
    text = same_form(key, kind, text)
    while not good(text):
        text = same_form(key, kind, text)
    return text


def _email(key: bytes, found: str) -> str:
    """Addresses that differ in large and small letters alone get surrogates that do, too."""
    local, _, domain = found.rpartition("@")
    label = "".join(chr(97 + _digest(key, "domain", domain.lower(), i) % 26) for i in range(14))
    folds = [c != c.lower() and c.lower().upper() == c and len(c.lower()) == 1 for c in local]
    made = same_form(key, "local", "".join(c.lower() if fold else c for c, fold in zip(local, folds, strict=True)))
    made = "".join(m.upper() if fold and len(m.upper()) == 1 else m for m, fold in zip(made, folds, strict=True))
    return f"{made}@{label}.example"


#: Fixed values: (prefix, its bits) of IPv6 addresses that are link-local, private and multicast, and of IPv4 addresses
#: that are private or link-local.
_IP6_RANGES = ((0x3FA, 10), (0x7E, 7), (0xFF, 8))
_IP4_RANGES = ((10, 8), (0xAC1, 12), (0xC0A8, 16), (0xA9FE, 16))


def _range_of(value: int, width: int, ranges: tuple) -> tuple[int, int] | None:
    return next((r for r in ranges if value >> (width - r[1]) == r[0]), None)


def _in_range(key: bytes, kind: str, value: int, width: int, prefix: tuple[int, int]) -> int:
    """Another address of the same range; a bijection of the range."""
    size = 1 << (width - prefix[1])
    return prefix[0] * size + permuted(key, f"{kind} {prefix[0]}", value % size, size)


def _ip6(key: bytes, found: str) -> str:
    """An address of the same kind, or else of the same first three bits, which tell global ones, written in full."""
    value = int(ipaddress.IPv6Address(found))
    prefix = _range_of(value, 128, _IP6_RANGES)
    if prefix:
        value = _in_range(key, "ip6", value, 128, prefix)
    else:
        value = value >> 125 << 125 | permuted(key, "ip6", value & ((1 << 125) - 1), 1 << 125)
        while _range_of(value, 128, _IP6_RANGES):
            value = value >> 125 << 125 | permuted(key, "ip6", value & ((1 << 125) - 1), 1 << 125)
    made = ipaddress.IPv6Address(value).exploded
    return made.upper() if found.upper() == found else made


def _is_ip6(found: str) -> bool:
    try:
        return int(ipaddress.IPv6Address(found)) > 1  # neither :: nor the machine itself
    except ValueError:
        return False


def _ip4(key: bytes, found: str) -> str:
    value = 0
    for octet in found.split("."):
        value = value * 256 + int(octet)
    # private addresses stay in their range, usual ones usual
    usual = lambda v: 1 <= v >> 24 <= 223 and v >> 24 != 127
    prefix, was = _range_of(value, 32, _IP4_RANGES), usual(value)
    if prefix:
        value = _in_range(key, "ip4", value, 32, prefix)
    else:
        value = permuted(key, "ip4", value, 1 << 32)
        while usual(value) != was or _range_of(value, 32, _IP4_RANGES):
            value = permuted(key, "ip4", value, 1 << 32)
    return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))


def _phone(key: bytes, found: str) -> str:
    digits = re.sub(r"\D", "", found)
    country = 0 if not found.startswith("+") else 1 if digits[0] in "17" else 2
    return _refill(found, digits[:country] + same_form(key, "phone", digits[country:]))


def _account(key: bytes, found: str) -> str:
    digits = re.sub(r"\D", "", found)
    valid = luhn(digits)
    return _refill(found, _walk(key, "account", digits, lambda d: luhn(d) == valid))


def _social(key: bytes, found: str) -> str:
    return _refill(found, same_form(key, "social", found.replace("-", "")))


def _iban(key: bytes, found: str) -> str:
    """Valid numbers get valid ones, of the same country and form, and others others."""
    plain = found.replace(" ", "")
    if _iban_rest(plain) == 1:
        body = same_form(key, "iban", plain[4:])
        made = f"{plain[:2]}{98 - _iban_rest(plain[:2] + '00' + body):02d}{body}"
    else:
        made = plain[:2] + _walk(key, "iban", plain[2:], lambda rest: _iban_rest(plain[:2] + rest) != 1)
    return _refill(found, made)


def _iban_rest(plain: str) -> int:
    """What the check digits are for: 1 for a valid number."""
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _script(name: str) -> str:
    return "cyrillic" if "а" <= name[-1].lower() <= "я" else "latin"


def _split(name: str) -> tuple[str, str]:
    """The name, and the possessive or the marks at its end."""
    at = len(name.rstrip("'’-"))
    if at > 1 and name[at - 1] in "sS" and name[at - 2] in "'’":
        at -= 2
    return name[:at], name[at:]


def _plain(name: str) -> str:
    """The name as it is compared: without possessive, in small letters, with one kind of apostrophe."""
    return _split(name)[0].lower().replace("’", "'")


def _number(key: bytes, name: str, script: str) -> int:
    """A number of its own for every name; one over 40 letters is numbered by its digest."""
    letters, further = SIGNS[script], FURTHER[script]
    base, signs = len(letters) + 2, []
    if len(name) > 40:
        name = f"{_digest(key, 'long', name):x}"
    for c in name:
        if c in letters:
            signs.append(letters.index(c))
        elif c in further:
            signs += [base - 2, further.index(c)]
        else:
            signs += [base - 1, *(ord(c) // base**i % base for i in range(5))]
    number = 0
    for sign in signs:
        number = number * base + sign + 1
    return number


def _made(key: bytes, kind: str, name: str) -> str:
    """Syllables for the name: four, or as many as tell all names of its length apart; an injection."""
    script = _script(name)
    consonants, vowels = SOUNDS[script]
    number, pair, pairs = _number(key, name, script), len(consonants) * len(vowels), 4
    while number >= pair**pairs:
        number, pairs = number - pair**pairs, pairs + 1
    number, made = permuted(key, f"{kind}:{script}", number, pair**pairs), []
    for _ in range(pairs):
        number, place = divmod(number, pair)
        made += [consonants[place // len(vowels)], vowels[place % len(vowels)]]
    return "".join(made)


def _variant(key: bytes, name: str, variant: int) -> str:
    """Syllables end in a vowel, so a variant's consonants at the end tell it from every other surrogate."""
    return _made(key, "surname", name) + SOUNDS[_script(name)][0][7] * variant


def _surname(names: Names, name: str) -> str:
    known, (stem, tail) = _plain(name), _split(name)
    made = _variant(names.key, known, names.variants.get(known, 0))
    return (made.upper() if stem.isupper() else made.capitalize()) + tail


def _listed(name: str) -> str | None:
    """The gender of the list that has the given name."""
    script = _script(name)
    return next((g for g in ("m", "f", "n") if name.capitalize() in GIVEN[g, script]), None)


def _given(names: Names, gender: str, name: str) -> str:
    """By the name's own list; else by the title's gender, or the gender that the corpus shows."""
    name, tail = _split(name)
    listed, script = _listed(name), _script(name)
    if listed:
        among = GIVEN[listed, script]
        made = among[permuted(names.key, f"given:{listed}", among.index(name.capitalize()), len(among))]
    else:
        known = _plain(name)
        gender = names.genders.get(known, "n") if gender == "n" else gender
        made = (_made(names.key, "given", known) + ENDINGS[script][gender]).capitalize()
    return (made.upper() if name.isupper() else made) + tail


def _initials(names: Names, gap: str) -> str:
    return "".join(same_form(names.key, "initial", c) if c.isalpha() else c for c in gap)


def _person(names: Names, match: re.Match) -> str:
    title, gap, first, space, last = match.groups()
    gap = gap[:1] + _initials(names, gap[1:])
    if last:
        return f"{title}{gap}{_given(names, _GENDER[title], first)}{_initials(names, space)}{_surname(names, last)}"
    return f"{title}{gap}{_surname(names, first)}"


def _people(text: str) -> list[tuple[str | None, str | None, str]]:
    """(gender of the title, given name, surname) of the persons of a text, found by a title or by a listed given name."""
    people = []
    for match in PERSON.finditer(text):
        title, _, first, _, last = match.groups()
        people.append((_GENDER[title], first if last else None, last or first))
    for match in UNTITLED.finditer(text):
        first, _, last = match.groups()
        if _is_untitled(first, last):
            people.append((None, first, last))
    return people


def _is_untitled(first: str, last: str) -> bool:
    return _listed(first) in ("m", "f") and _plain(last) not in NO_NAMES


_MAKERS: list[tuple[str, re.Pattern, Callable[[bytes, str], str]]] = [
    ("iban", IBAN, _iban),
    ("ip6", IP6, _ip6),
    ("ip4", IP4, _ip4),
    ("social", SOCIAL, _social),
    ("account", ACCOUNT, _account),
    ("phone", PHONE, _phone),
]


def entities(text: str) -> list[tuple[int, int, str, re.Match]]:
    """(start, end, kind, match) of the entities, in order; of overlapping ones the first kind found stays.

    Emails come first, then account numbers and addresses, phones and persons, and last every
    other mention of a person's names in the text. A surname counts before a given name.
    """
    found: list[tuple[int, int, str, re.Match]] = []
    taken = bytearray()

    def add(kind: str, match: re.Match) -> None:
        start, end = match.span()
        if not taken:
            taken.extend(bytes(len(text)))
        if not any(taken[start:end]):
            taken[start:end] = b"\x01" * (end - start)
            found.append((start, end, kind, match))

    at = text.find("@")
    while at >= 0:
        local = LOCAL.search(text, max(0, at - 64), at)
        match = local and EMAIL.match(text, local.start())
        if match:
            add("email", match)
        at = text.find("@", at + 1)
    if _DIGIT.search(text) or "::" in text:
        for kind, pattern, _ in _MAKERS:
            for match in pattern.finditer(text):
                if kind != "ip6" or _is_ip6(match.group()):
                    add(kind, match)
    for match in PERSON.finditer(text):
        add("person", match)
    people = _people(text)
    if people:
        mentions = {_plain(first): f"given-{gender or 'n'}" for gender, first, _ in people if first}
        mentions |= {_plain(last): "surname" for _, _, last in people}
        for match in WORD.finditer(text):
            kind = mentions.get(_plain(match.group()))
            if kind and _plain(match.group()) not in NO_NAMES:
                add(kind, match)
    return sorted(found, key=lambda e: e[:2])


def surrogate(key: bytes, names: Names, kind: str, match: re.Match) -> str:
    if kind == "person":
        return _person(names, match)
    if kind == "surname":
        return _surname(names, match.group())
    if kind.startswith("given-"):
        return _given(names, kind[-1], match.group())
    if kind == "email":
        return _email(key, match.group())
    return next(make for k, _, make in _MAKERS if k == kind)(key, match.group())


def replaced(text: str, key: bytes, names: Names) -> tuple[str, int]:
    """The text with surrogates, and the number of entities."""
    parts, at = [], 0
    found = entities(text)
    for start, end, kind, match in found:
        parts += [text[at:start], surrogate(key, names, kind, match)]
        at = end
    return "".join([*parts, text[at:]]), len(found)


def _persons(docs: DataFrame) -> DataFrame:
    """The (digest, role, name, gender) of each text's surnames and given names outside the lists, as they are compared."""
    columns = ["digest", "role", "name", "gender"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for gender, first, last in _people(text or ""):
                    rows.add((digest, "surname", _plain(last), None))
                    if first and not _listed(_split(first)[0]):
                        rows.add((digest, "given", _plain(first), gender))
            arrays = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.select(F.md5("text").alias("digest"), "text").mapInArrow(run, schema)


def _with_variant(names: DataFrame, key: bytes, variant: int) -> DataFrame:
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("made", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([_variant(key, n, variant) for n in batch.column("name").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("name"), made], names=["name", "made"])

    return names.select("name").mapInArrow(run, schema)


def name_key(docs: DataFrame, settings: Settings) -> Names:
    """The key for names, and a table of the texts that need more than the key, by the digest of the text.

    Texts are scanned once. Surrogates never meet each other; the join finds those that are
    surnames, and only these names go on to the next variant. Nothing of this comes to the
    driver: each text gets the variants and genders of its own names by joins.
    """
    key = hmac.digest(settings.key, b"names", hashlib.sha256)
    scratch = Scratch(docs.sparkSession, "names")
    persons = scratch.settle(_persons(docs), "persons")
    given = persons.filter("role = 'given'").groupBy("name").agg(F.collect_set("gender").alias("all"))
    given = given.filter("size(all) > 1 AND array_contains(all, 'n')").select("name", F.array_remove("all", "n").alias("all"))
    genders = given.filter("size(all) = 1").select("name", F.col("all")[0].alias("gender"))
    names = scratch.settle(persons.filter("role = 'surname'").select("name").distinct(), "surnames")
    left, variants, variant = names, names.select("name", F.lit(0).alias("variant")).limit(0), 0
    while True:
        if settings.tries is not None and variant >= settings.tries:
            raise ValueError("surnames of the corpus are surrogates of one another in every variant tried")
        made = _with_variant(left, key, variant)
        left = scratch.settle(made.join(names.select(F.col("name").alias("made")), "made", "left_semi").select("name"), "met")
        if left.isEmpty():
            break
        variant += 1
        variants = variants.unionByName(left.select("name", F.lit(variant).alias("variant")))
    variants = variants.groupBy("name").agg(F.max("variant").alias("variant"))
    special = persons.filter("role = 'surname'").join(variants, "name").select("digest", "name", "variant", F.lit(None).cast("string").alias("gender"))
    neutral = persons.filter("role = 'given' AND gender = 'n'").drop("gender").join(genders, "name")
    special = special.unionByName(neutral.select("digest", "name", F.lit(None).cast("int").alias("variant"), "gender"))
    pairs = [F.map_from_entries(F.collect_set(F.when(F.col(c).isNotNull(), F.struct("name", c)))).alias(c) for c in ("variant", "gender")]
    by_text = scratch.settle(special.groupBy("digest").agg(*pairs), "by-text")
    scratch.drop_all_but(by_text)
    return Names(key, by_text=by_text)


def with_surrogates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents, all columns kept, with surrogates in `text`; `n_chars` follows where it is there.

    Detected: email addresses, IPv4 and IPv6 addresses, phone numbers, social security numbers,
    account and card numbers (12 to 19 digits, with their check digit right or wrong as before),
    IBANs, names after a title, surnames after a given name of the lists, and every other
    mention of these names in the same text. Null and empty texts, and texts without entities, stay as they
    are. Repeated rows get the same text. Extra columns are passed on, whatever they are called.
    """
    settings = settings or Settings()
    names = name_key(docs, settings)
    columns, key = docs.columns, names.key
    rows = docs.select(F.struct("*").alias("row"), F.md5("text").alias("digest")).join(names.by_text, "digest", "left").drop("digest")

    def make():
        def made(text: str | None, variant: list | None, gender: list | None) -> str | None:
            return None if text is None else replaced(text, settings.key, Names(key, dict(variant or ()), dict(gender or ())))[0]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            whole = batch.column("row").flatten()
            needed = (whole[columns.index("text")], batch.column("variant"), batch.column("gender"))
            texts = [made(*r) for r in zip(*(c.to_pylist() for c in needed), strict=True)]
            arrays = []
            for name, column in zip(columns, whole, strict=True):
                if name == "text":
                    column = pa.array(texts, column.type)
                elif name == "n_chars" and pa.types.is_integer(column.type):
                    column = pa.array([None if t is None else len(t) for t in texts], column.type)
                arrays.append(column)
            return pa.RecordBatch.from_arrays(arrays, names=columns)

        return work

    return map_batches(rows, make, docs.schema)

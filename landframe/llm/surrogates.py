"""Personal data in texts: detection, and keyed surrogates of the same type and format."""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata

# Given names by script and gender
GIVEN_NAMES = {
    ("latin", "f"): ["Maria", "Anna", "Sophie", "Emma", "Julia", "Laura", "Claire", "Isabel", "Ingrid", "Margaret", "Jennifer", "Patricia"],
    ("latin", "m"): ["Peter", "Michael", "Thomas", "Robert", "William", "Hans", "Pierre", "Carlos", "Javier", "Andrew", "Stephen", "Wolfgang"],
    ("cyrillic", "f"): ["Мария", "Анна", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана"],
    ("cyrillic", "m"): ["Иван", "Сергей", "Дмитрий", "Алексей", "Андрей", "Михаил", "Николай", "Владимир"],
    ("greek", "f"): ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Γεωργία"],
    ("greek", "m"): ["Γιώργος", "Νίκος", "Δημήτρης", "Κώστας", "Γιάννης", "Παναγιώτης"],
}
_GIVEN = {n.casefold(): (names, i) for names in GIVEN_NAMES.values() for i, n in enumerate(names)}
_GIVEN_WRITTEN = {form for names in GIVEN_NAMES.values() for n in names for form in (n, n.upper())}

# letters from which surrogate letters are drawn: (vowels, consonants) by script
LETTERS = {
    "latin": ("aeiou", "bcdfghjklmnprstvwz"),
    "cyrillic": ("аеиоуя", "бвгдзклмнпрстфх"),
    "greek": ("αεηιοω", "βγδθκλμνπρτφχ"),
}

_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]*\w@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)")
# national numbers: a trunk 0 and groups behind equal separators, 9 to 12 digits together
_NATIONAL = re.compile(r"(?:\((?<![\w+.,:/-]\()0\d{1,4}\)[ -]?\d{2,8}(?:[ -]\d{2,8})*|0(?<![\w+.,:/-]0)(?<!\d 0)\d{1,4}(?:/ ?\d{2,8}(?:[ -]\d{2,8})*|([ -])\d{2,8}(?:\1\d{2,8})*|(?:\.\d{2,4}){2,5}))(?![\w]|[.,:-]\d)")
# digits after a word for telephones, 7 to 15 together
_CALLED = re.compile(r"(?<!\w)(?:tel(?:e(?:ph|f)one?|éfono|éphone)?|phone|mobile?|móvil|portable|handy|fax|тел(?:ефон)?|τηλ(?:έφωνο)?)\.?(?: (?:number|no|nr|nummer|is|ist|est|es)\.?){0,2} ?[:=]? ?(\(?\d(?:[ ./()-]{0,2}\d){6,14})(?!\w)", re.I)
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
_IP6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{3,39}(?:(?<=:)(?:\d{1,3}\.){3}\d{1,3})?(?![\w:]|\.\d)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)")
_NUMBER = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w)")

# What announces a name, and what a name does not consist of
TITLES = {"Mr", "Mrs", "Ms", "Miss", "Mx", "Dr", "Prof", "Professor", "Sir", "Lady", "Frau", "Herr", "Herrn", "Monsieur", "Madame", "Mademoiselle",
          "Mme", "Mlle", "Señor", "Señora", "Señorita", "Sr", "Sra", "Srta", "Signor", "Signora", "господин", "госпожа", "Господин", "Госпожа",
          "κύριος", "κυρία", "Κύριος", "Κυρία"}
CUES = ["my name is", "his name is", "her name is", "name:", "mein name ist", "ich heiße", "je m'appelle", "je m’appelle", "mon nom est", "me llamo",
        "mi nombre es", "mi chiamo", "меня зовут", "με λένε"]
PARTICLES = {"von", "van", "vom", "zu", "zur", "zum", "de", "del", "della", "di", "da", "dal", "dos", "das", "do", "du", "des", "af", "av", "ter", "ten",
             "bin", "ibn", "y", "der", "den", "la", "le", "el", "al", "las", "los"}
_ARTICLES = {"der", "den", "das", "la", "le", "el", "las", "los", "y"}  # no name begins with them in small letters
_NO_NAMES = {"the", "a", "an", "and", "or", "of", "in", "on", "at", "to", "for", "from", "by", "with", "is", "was", "are", "were", "has", "had", "he", "she",
             "it", "they", "we", "you", "this", "that", "but", "as", "who", "if", "when", "then", "there", "his", "her", "my", "our", "not", "no",
             "die", "das", "ein", "eine", "und", "oder", "ist", "war", "hat", "er", "sie", "es", "wir", "ich", "mit", "bei", "im", "am", "auf", "für", "aus", "nicht",
             "les", "un", "une", "et", "ou", "est", "il", "elle", "en", "dans", "pour", "avec", "sur", "que", "qui",
             "una", "los", "las", "con", "por", "para", "su", "ella", "se", "и", "в", "на", "с", "он", "она", "это", "не", "και", "το", "η", "ο", "να"}

_BEGINS = _GIVEN_WRITTEN | TITLES
_CAPITAL = re.compile(r"[A-Z\u0370-\u052F][^\W\d_]+")  # what may be one of them, fast
_WORDS = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*")
# blanks inside a name: any, with one line break at most
_NEXT = re.compile(r"(\.?(?:[^\S\r\n]+|[^\S\r\n]*\r?\n[^\S\r\n]*))([^\W\d_]+(?:[-’'][^\W\d_]+)*)(?!\w)")
_CUE = re.compile(r"(?<!\w)(?:" + "|".join(re.escape(c).replace(r"\ ", r"\s+") for c in CUES) + r")(?=\s)", re.I)
_CUE_SIGNS = ["name", "nombre", "heiße", "appelle", "mon nom", "llamo", "chiamo", "зовут", "λένε"]  # every cue holds one
_CALLED_SIGNS = ["tel", "phone", "mobil", "móvil", "portable", "handy", "fax", "тел", "τηλ"]


def bare(word: str) -> str:
    """A word without the genitive's 's."""
    return word[:-2] if word[-2:] in ("'s", "’s") else word


def name_words(text: str, at: int, announced: bool) -> dict[str, str]:
    """Words (case-folded) and kinds of the name that goes on at ``at``: listed given names,
    initials, particles and up to three surnames.  A line may break before the first surname
    only, and a point stands only behind initials and (``announced``) titles."""
    words, surnames, particles, point = {}, 0, 0, announced
    while m := _NEXT.match(text, at):
        blank, word, fold = m[1], bare(m[2]), bare(m[2]).casefold()
        if blank[0] == "." and not point or surnames and ("\n" in blank or "\r" in blank):
            break
        point = False
        if word in _GIVEN_WRITTEN and not surnames:
            words[fold] = "given"
        elif word in TITLES or len(word) == 1 and word.isupper():
            point = True
        elif fold in PARTICLES and particles < 4 and (word[0].isupper() or particles or fold not in _ARTICLES):
            particles += 1
        elif word[0].isupper() and len(word) > 1 and fold not in _NO_NAMES and surnames < 3:
            words.setdefault(fold, "surname")
            surnames += 1
        else:
            break
        at = m.end()
    return words


def find_names(text: str) -> dict[str, str]:
    """Case-folded words of the personal names of a text and their kinds: listed given names
    with the name that goes on, and names behind a title or a cue such as "my name is"."""
    found: list[tuple[str, str]] = []
    if not _BEGINS.isdisjoint(_CAPITAL.findall(text)):
        for m in _WORDS.finditer(text):
            if m.start() and (text[m.start() - 1].isdigit() or text[m.start() - 1] == "_"):
                continue
            first, *rest = m[0].split("-")
            if m[0] in TITLES:
                found += name_words(text, m.end(), True).items()
            elif first in _GIVEN_WRITTEN and all(r[:1].isupper() for r in rest):
                more = name_words(text, m.end(), False)
                if more:
                    found += [(m[0].casefold(), "surname" if rest else "given"), *more.items()]
    lower = text.lower()
    if any(c in lower for c in _CUE_SIGNS):
        for m in _CUE.finditer(text):
            found += name_words(text, m.end(), False).items()
    names = {}
    for word, kind in found:
        if names.get(word) != "given":
            names[word] = kind
    return names


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_remainder(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def ip6(s: str) -> str | None:
    """The normal form of an IPv6 address; None of anything else, of names such as ``add::be``
    and of ``::1``, which is every host's."""
    try:
        address = ipaddress.IPv6Address(s)
    except ValueError:
        return None
    if int(address) < 2 or not any(c.isdigit() for c in s):
        return None
    return ":".join(f"{int(address) >> 16 * i & 0xFFFF:x}" for i in reversed(range(8)))


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def find_entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of personal data, by start, without overlaps.

    The normal form is equal for all spellings of one entity: digits of numbers, case-folded
    addresses and names.  Given names and surnames count when a full name stands in the text;
    then their single mentions count too."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].casefold()) for m in _EMAIL.finditer(text)]
    if not text.isascii() or any(d in text for d in "0123456789"):
        for m in _PHONE.finditer(text):
            code, _, rest = m[0].partition(" ") if m[0][0] == "+" else ("", "", m[0])
            found.append((m.start(), m.end(), "phone", f"{_digits(code)}+{_digits(rest)}"))
        found += [(m.start(), m.end(), "phone", "+" + _digits(m[0])) for m in _NATIONAL.finditer(text) if 9 <= len(_digits(m[0])) <= 12]
        lower = text.lower()
        if any(c in lower for c in _CALLED_SIGNS):
            found += [(m.start(1), m.end(1), "phone", "+" + _digits(m[1])) for m in _CALLED.finditer(text)]
        if "::" in text or text.count(":") > 6:
            found += [(m.start(), m.end(), "ip", norm) for m in _IP6.finditer(text) if (norm := ip6(m[0]))]
        found += [(m.start(), m.end(), "ip", m[0]) for m in _IP.finditer(text) if max(map(int, m[0].split("."))) < 256]
        found += [(m.start(), m.end(), "ssn", _digits(m[0])) for m in _SSN.finditer(text)]
        found += [(m.start(), m.end(), "iban", m[0]) for m in _IBAN.finditer(text) if iban_remainder(m[0]) == 1]
        for m in _NUMBER.finditer(text):
            number = _digits(m[0])
            found.append((m.start(), m.end(), "card" if luhn(number) else "account", number))
    names = find_names(text)
    if names:
        for m in _WORDS.finditer(text):
            word = m[0] if m[0].casefold() in names else bare(m[0])
            kind = names.get(word.casefold())
            if kind and word[0].isupper():
                found.append((m.start(), m.start() + len(word), kind, word.casefold()))
    order = ["email", "phone", "ip", "ssn", "iban", "card", "account", "given", "surname"]
    out: list[tuple[int, int, str, str]] = []
    for span in sorted(found, key=lambda s: (s[0], order.index(s[2]), -s[1])):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


class Stream:
    """Keyed pseudo-random numbers for one entity and attempt."""

    def __init__(self, key: bytes, *about: object):
        self.key, self.about, self.n, self.left = key, "\0".join(map(str, about)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left += hashlib.blake2b(self.about + b"\0%d" % self.n, key=self.key).digest()
            self.n += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n

    def digit(self, least: int = 0) -> str:
        return str(least + self.below(10 - least))


def like_char(c: str, draw: Stream) -> str:
    """A character of the same class: a digit, or a vowel or consonant of the script."""
    if c.isdigit():
        return draw.digit()
    if not c.isalpha():
        return c
    name = unicodedata.name(c, "")
    plain = unicodedata.normalize("NFD", c)[0]
    for script, (vowels, consonants) in LETTERS.items():
        if name.startswith(script.upper()):
            pool = vowels if plain in vowels else consonants
            return pool[draw.below(len(pool))]
    if "CJK" in name:
        return chr(0x4E00 + draw.below(0x2000))
    if "HANGUL" in name:
        return chr(0xAC00 + draw.below(11172))
    return LETTERS["latin"][1][draw.below(18)]


def surrogate(kind: str, norm: str, key: bytes, attempt: int) -> str:
    """A replacement in normal form: same type, length and format; from the 16th attempt on
    numbers and names grow, so that room is found in the end.  An IP then takes parts of any
    length, and an IPv6 address from the 64th attempt on, should most of IPv4 be taken; only
    given names never grow, they are mapped one to one."""
    draw = Stream(key, kind, norm, attempt)
    grown = max(0, attempt - 15)
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        labels = domain.split(".")
        at_domain = Stream(key, "domain", domain)  # addresses of one domain stay together
        host = ["".join(like_char(c, at_domain) for c in label) for label in labels[:-1]]
        return "".join(like_char(c, draw) for c in local + "a" * grown) + "@" + ".".join([*host, labels[-1]])
    if kind == "given":
        names, i = _GIVEN[norm]
        # a keyed cycle through the names of the same gender and script: one to one
        cycle = sorted(range(len(names)), key=lambda j: Stream(key, "given", names[j]).below(2**64))
        return names[cycle[(cycle.index(i) + 1) % len(cycle)]].casefold()
    if kind == "surname":
        return "".join(like_char(c, draw) for c in norm + norm[-1:] * grown)
    if kind == "phone":
        code, _, rest = norm.partition("+")
        return code + "+" + "".join(
            "0" if i == 0 and c == "0" and not code else draw.digit(i == 0 and c != "0") for i, c in enumerate(rest + "0" * grown))
    if kind == "ip":
        if grown > 48 or grown and ":" in norm:
            return ":".join(f"{0x1000 + draw.below(0xF000):x}" for _ in range(8))
        if ":" in norm:  # groups of zeros stay, others keep their lengths
            groups = [g if g == "0" else "123456789"[draw.below(9)] + "".join(f"{draw.below(16):x}" for _ in g[1:]) for g in norm.split(":")]
            return ":".join(groups)
        if grown:
            return ".".join(str(draw.below(256)) for _ in range(4))
        low, high = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 100, 3: 256}
        return ".".join(str(low[len(p)] + draw.below(high[len(p)] - low[len(p)])) for p in norm.split("."))
    if kind == "ssn":
        area = 1 + draw.below(898)
        return f"{area + (area >= 666):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}" + "".join(draw.digit() for _ in range(grown))
    if kind == "iban":
        body = "".join(draw.digit() if c.isdigit() else chr(65 + draw.below(26)) for c in norm[4:] + "0" * grown)
        return f"{norm[:2]}{98 - iban_remainder(norm[:2] + '00' + body):02d}{body}"
    body = norm[0] + "".join(draw.digit() for _ in norm[1:-1]) + "0" * grown
    check = next(d for d in "0123456789" if luhn(body + d))
    return body + (check if kind == "card" else str((int(check) + 1 + draw.below(9)) % 10))


def render(written: str, kind: str, replacement: str) -> str:
    """The replacement in the written entity's format: separators of numbers, case of letters."""
    if kind in ("phone", "card", "account", "ssn"):
        digits = iter(_digits(replacement))
        out = "".join(next(digits, "") if c.isdigit() else c for c in written)
        return out + "".join(digits)
    if kind in ("given", "surname", "email"):
        if written.isupper():
            return replacement.upper()
        if kind != "email" and len(replacement) != len(written):
            return replacement[:1].upper() + replacement[1:]
        return "".join(r.upper() if i < len(written) and written[i].isupper() else r for i, r in enumerate(replacement))
    if kind == "ip" and "::" in written:
        return ipaddress.IPv6Address(replacement).compressed if ":" in replacement else replacement
    return replacement


def replace_entities(text: str, mapping: dict[tuple[str, str], str]) -> str:
    out, at = [], 0
    for a, b, kind, norm in find_entities(text):
        new = mapping.get((kind, norm))
        if new is not None:
            out += [text[at:a], render(text[a:b], kind, new)]
            at = b
    return "".join([*out, text[at:]])
